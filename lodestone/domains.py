"""Fixed values of the registry's data model."""

from __future__ import annotations

# Codes, labels and cuts must equal the publisher's and the published definitions.
STATUSES = {"01": "NULA", "02": "ATIVA", "03": "SUSPENSA", "14": "PARALISADA", "15": "ENCERRADA"}
QUALIFICATIONS = {
    "0053": "Pessoa Jurídica Construtora",
    "0057": "Dono da Obra",
    "0064": "Incorporador de Construção Civil",
    "0070": "Proprietário do Imóvel",
    "0109": "Consórcio",
    "0110": "Construção em nome coletivo",
    "0111": "Sociedade Líder de Consórcio",
}
STATES = "AC AL AP AM BA CE DF ES GO MA MT MS MG PA PB PR PE PI RJ RN RS RO RR SC SP SE TO".split()
STATE_CORRECTIONS = {"SÃO PAULO": "SP", "PERNAMBUCO": "PE"}
SENTINEL_DATES = ("1900-01-01", "1970-01-01", "0001-01-01")
SUSPICIOUS_AREA_M2 = 1_000_000
HOME_COUNTRY = "105"
CNAE_SECTIONS = (
    (1, 3, "A", "Agricultura, pecuária, produção florestal, pesca e aquicultura"),
    (5, 9, "B", "Indústrias extrativas"),
    (10, 33, "C", "Indústrias de transformação"),
    (35, 35, "D", "Eletricidade e gás"),
    (36, 39, "E", "Água, esgoto, gestão de resíduos e descontaminação"),
    (41, 43, "F", "Construção"),
    (45, 47, "G", "Comércio e reparação de veículos automotores e motocicletas"),
    (49, 53, "H", "Transporte, armazenagem e correio"),
    (55, 56, "I", "Alojamento e alimentação"),
    (58, 63, "J", "Informação e comunicação"),
    (64, 66, "K", "Atividades financeiras, de seguros e serviços relacionados"),
    (68, 68, "L", "Atividades imobiliárias"),
    (69, 75, "M", "Atividades profissionais, científicas e técnicas"),
    (77, 82, "N", "Atividades administrativas e serviços complementares"),
    (84, 84, "O", "Administração pública, defesa e seguridade social"),
    (85, 85, "P", "Educação"),
    (86, 88, "Q", "Saúde humana e serviços sociais"),
    (90, 93, "R", "Artes, cultura, esporte e recreação"),
    (94, 96, "S", "Outras atividades de serviços"),
    (97, 97, "T", "Serviços domésticos"),
    (99, 99, "U", "Organismos internacionais e outras instituições extraterritoriais"),
)
CNAE_DIVISIONS = {"41": "Construção de edifícios", "42": "Obras de infraestrutura", "43": "Serviços especializados para construção"}
AREA_BANDS = ((None, 70, "até 70 m²"), (70, 150, "70 a 150 m²"), (150, 500, "150 a 500 m²"), (500, 5000, "500 a 5.000 m²"), (5000, None, "acima de 5.000 m²"))
PLAUSIBLE_KM = 150
FIRST_COMPARABLE_YEAR = 2019
EARTH_KM = 6371
OLC_ALPHABET = "23456789CFGHJMPQRVWX"
HISTOGRAM_TOP, HISTOGRAM_STEP = 1000, 20
CONTROL_TOTALS = {"obras": "cno", "areas": "cno_areas", "cnaes": "cno_cnaes", "vinculos": "cno_vinculos"}
MAX_EXAMPLES = 5
