"""A package of twelve works, each a case of its own, in the publisher's format."""

import csv
import io
import json

from lodestone.plans import staging

USUAL = {
    "Código do Pais": "105", "Nome do pais": "BRASIL", "Data de início": "2020-03-15", "Data de registro": "2022-05-17", "Qualificação do responsavel": "0070",
    "Nome": "OBRA", "Código do municipio": "8105", "Nome do município": "FLORIANÓPOLIS", "Estado": "SC", "Unidade de medida": "m2", "Área total": "412.00",
    "Situação": "02", "Data da situação": "2021-06-01", "Código de localização": "58PJ64Q5+JP",
}
CASES = {
    "278": {}, "379": {"NI do responsável": "12345678000199"}, "380": {"Data de início": "1970-01-01", "Data da situação": "1970-01-01"}, "381": {"Data de início": "1900-01-01"},
    "382": {"Área total": "555555555555.55"}, "383": {"Área total": "9999999.00", "Unidade de medida": "km"}, "384": {"Estado": "SÃO PAULO"}, "385": {"Estado": "estado"},
    "386": {"Estado": "EX", "Código do Pais": "249"}, "387": {"Código de localização": ""}, "388": {"Situação": "15", "Código de localização": "64Q5+JP"},
    "389": {"Nome": "CASA – FUNDOS", "Código de localização": "8Q4GQRQP+J2"},
}


def work(last: str) -> str:
    return f"600000000{last}"


def _file(table, rows: list[dict]) -> bytes:
    out = io.StringIO()
    writer = csv.DictWriter(out, table.headers, restval="", lineterminator="\n", quoting=csv.QUOTE_ALL)
    writer.writeheader()
    writer.writerows(rows)
    return out.getvalue().encode("cp1252")


def package() -> dict[str, bytes]:
    first = work("278")
    area = {"CNO": first, "Categoria": "Obra Nova", "Destinação": "Residencial", "Tipo de obra": "Alvenaria", "Tipo de Área": "Principal", "Metragem": "412.00"}
    return {
        "cno.csv": _file(staging.WORKS, [{**USUAL, "CNO": work(k), **v} for k, v in CASES.items()]),
        "cno_areas.csv": _file(staging.AREAS, [area, area, {**area, "Tipo de Área": "Complementar", "Metragem": "20.00"}, {**area, "CNO": work("379")}]),
        "cno_cnaes.csv": _file(staging.ACTIVITIES, [{"CNO": first, "CNAE": "4120400", "Data de registro": "2022-05-17"}, {"CNO": first, "CNAE": "4399103", "Data de registro": "2022-05-18"}]),
        "cno_vinculos.csv": _file(staging.LINKS, [{"CNO": first, "Data de início": "2020-01-01", "Qualificação do contribuinte": "0057"}] * 2 + [{"CNO": work("379"), "Data de início": "2020-01-01", "Data de fim": "2021-01-01"}]),
        "cno_totais.csv": "Total de obras,Total de cnaes,Total de áreas,Total de vínculos\n0012,0002,0004,0003\n".encode("cp1252"),
    }


def unpacked(settings, snapshot: str) -> None:
    """As the extract stage leaves it."""
    folder = settings.data / "raw" / f"snapshot_date={snapshot}" / "csv"
    folder.mkdir(parents=True)
    for name, data in package().items():
        (folder / name).write_bytes(data)
    manifest = {"snapshot": snapshot, "files": {n: {"path": str(folder / n)} for n in package()}, "totals": {"cno": 12, "cno_cnaes": 2, "cno_areas": 4, "cno_vinculos": 3}}
    for name in (snapshot, "latest"):
        path = settings.manifest("extract", name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(manifest))
