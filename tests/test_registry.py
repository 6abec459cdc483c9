import json
import threading
import zipfile
from datetime import date
from decimal import Decimal
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
import registry
from pyspark.sql import functions as F

from lodestone import domains as D
from lodestone.functions import columns as X
from lodestone.functions import olc
from lodestone.plans import curate, pipeline, rules, staging
from lodestone.plans.questions import Questions
from lodestone.sources import files
from lodestone.sources.tables import SourceError, read_csv, read_snapshot, snapshots


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    s = pipeline.Settings(tmp_path_factory.mktemp("data"))
    registry.unpacked(s, "2026-09-12")
    out = {"transform": pipeline.transform(spark, s), "validate": pipeline.validate(spark, s), "curate": pipeline.run_curate(spark, s)}
    base = f"{s.data}/curated"
    return s, out, Questions.open(spark, base)


def staged(spark, done, table):
    return read_snapshot(spark, f"{done[0].data}/staging/{table}")


def test_staging(spark, done):
    t = done[1]["transform"]["tabelas"]
    assert {k: (v["lidas"], v["linhas"]) for k, v in t.items()} == {"obras": (12, 12), "areas": (4, 3), "cnaes": (2, 2), "vinculos": (3, 2)}
    rows = {r["cno"][-3:]: r for r in staged(spark, done, "obras").collect()}
    assert rows["379"]["responsavel_tipo"] == "PJ" and sum(r["responsavel_tipo"] == "PF" for r in rows.values()) == 11
    assert rows["380"]["data_inicio"] is None and rows["380"]["data_situacao"] is None and rows["381"]["data_inicio"] is None
    assert rows["382"]["area_suspeita"] and not rows["383"]["area_suspeita"]
    assert (rows["384"]["uf"], rows["385"]["uf"], rows["386"]["uf"], rows["386"]["no_exterior"]) == ("SP", None, None, True)
    assert rows["389"]["nome_obra"] == "CASA – FUNDOS" and rows["278"]["area_total"] == Decimal("412.00")
    assert sum(r["tem_plus_code"] for r in rows.values()) == 11


def test_validation_passes_with_two_warnings(done):
    report = done[1]["validate"]
    assert report["passou"] and len(report["outcomes"]) == 19
    assert {o["rule"]: o["violations"] for o in report["outcomes"] if o["violations"]} == {"obras.area_plausivel": 1, "obras.uf_identificada": 1}


def test_defects_are_found(spark, done):
    tables = {n: staged(spark, done, n) for n in staging.TABLES}
    double = tables | {"obras": tables["obras"].unionByName(tables["obras"].limit(1))}
    read = {"obras": 12, "areas": 4, "cnaes": 2, "vinculos": 3}
    assert not rules.validate(double, "x", read, {}).passed
    orphan = tables | {"areas": tables["areas"].withColumn("cno", F.lit("999999999999"))}
    found = {o.rule: o.violations for o in rules.validate(orphan, "x", read, {}).outcomes}
    assert found["areas.cno_existe_em_obras"] == 3
    assert not rules.validate(tables, "x", read, {"cno": 99999}).passed and rules.validate(tables, "x", read, {"cno": 12}).passed
    with pytest.raises(rules.ValidationError):
        rules.evaluate(rules.Rule("broken", rules.ERROR, lambda t: t["obras"].filter("no_such_column = 1")), tables)
    late = rules.validate(tables, "x", read, {}, today=date(2020, 1, 1)).outcomes
    assert {o.rule: o.violations for o in late}["obras.data_inicio_nao_futura"] == 10


def test_curated(spark, done):
    works = read_snapshot(spark, f"{done[0].data}/curated/obras_analitico")
    rows = {r["cno"][-3:]: r for r in works.collect()}
    assert len(rows) == 12 and rows["278"]["n_areas"] == 2 and rows["278"]["cnae_principal"] == "4120400" and rows["278"]["cnae_secao"] == "F"
    assert rows["382"]["area_m2"] is None and rows["383"]["area_m2"] is None and rows["278"]["faixa_area"] == "150 a 500 m²"
    assert rows["388"]["geo_origem"] == "curto_recuperado" and abs(rows["388"]["latitude"] + 15.76) < 0.01 and abs(rows["388"]["longitude"] + 47.89) < 0.01
    assert not rows["389"]["geo_plausivel"] and rows["389"]["geo_distancia_municipio_km"] > 1000
    assert sum(r["geo_plausivel"] for r in rows.values()) == 10 and rows["381"]["serie_comparavel"] is None
    for name in curate.MARTS:
        mart = read_snapshot(spark, f"{done[0].data}/curated/{name}")
        assert mart.agg(F.sum("n_obras"), F.sum("area_m2_total")).first()[:] == (12, Decimal("4120.00"))
    geo = done[1]["curate"]["geo"]
    assert (geo["completos"], geo["curtos"], geo["recuperados"], geo["plausiveis"]) == (10, 1, 1, 10)


def test_questions(done):
    q = done[2]
    assert [tuple(r) for r in q.decomposicao_area().collect()] == [("SUM(area_total) cru", 555565.6), ("sem as áreas implausíveis", 10.0), ("só o que está em m²", 555555.6), ("m² e sem implausíveis (area_m2)", 0.0)]
    assert [tuple(r) for r in q.responsavel().collect()] == [("PF", 11, 91.7), ("PJ", 1, 8.3)]
    assert [tuple(r) for r in q.responsavel(uf="XX").collect()] == [("PF", 0, 0.0), ("PJ", 0, 0.0)]
    assert [tuple(r) for r in q.funil_geocodificacao().collect()] == [("contém um '+'", 11, 91.7), ("decodifica de fato", 11, 91.7), ("cai no município certo", 10, 83.3)]
    assert q.total_obras() == 12 and q.total_obras("SC") == 9 and q.total_obras("XX") == 0
    assert [r.uf for r in q.ufs_disponiveis().collect()] == ["SC", "SP"]
    assert q.ask("quantis_area") is q.ask("quantis_area")
    for name in ("totais_do_cabecalho volumetria perfil_unidades areas_implausiveis quantis_area histograma_area faixas_area cardinalidade situacao perfil_geo distancia_geo pontos_fora "
                 "mapa_municipios obras_por_ano entrada_no_cadastro registro_de_obras_antigas atraso_de_registro datas_ausentes ranking_ufs municipios divisoes_cnae destinacoes cobertura_referencias").split():
        assert getattr(q, name)().collect() is not None
    assert q.regioes("SC").collect() == []


def test_reference_tables(spark, done):
    q = done[2]
    q.places = spark.createDataFrame([("4205407", "Florianópolis", "SC", "a", "b", 1000, -27.6, -48.5)], "codigo_ibge string, nome string, uf string, regiao_imediata string, regiao_intermediaria string, populacao long, latitude double, longitude double")
    q.corrections = spark.createDataFrame([], "uf string, nome_cno string, codigo_ibge string")
    assert q.regioes("SC").first()["obras"] == 9 and q.prefixo_ibge("SC") == "42" and q.ranking_ufs().first()["obras_por_mil_hab"] == 9.0
    assert q.municipios(populacao_minima=1).count() == 1 and q.municipios().count() == 3
    q.places = q.corrections = None


def test_snapshot_is_replaced_alone(spark, done):
    s = done[0]
    registry.unpacked(s, "2026-10-12")
    pipeline.transform(spark, s)
    pipeline.transform(spark, s)
    pipeline.run_curate(spark, s)
    assert snapshots(spark, f"{s.data}/staging/obras") == ["2026-09-12", "2026-10-12"]
    assert read_snapshot(spark, f"{s.data}/staging/obras", "2026-09-12").count() == 12
    assert Questions.open(spark, f"{s.data}/curated").total_obras() == 12
    with pytest.raises(SourceError):
        read_snapshot(spark, f"{s.data}/staging/obras", "1999-01-01")


def test_undefined_bytes_and_ragged_rows_fail(spark, tmp_path):
    for data in (b"a,b\n1,\x81\n", b"a,b\n1,2,3\n"):
        path = tmp_path / "x.csv"
        path.write_bytes(data)
        with pytest.raises(Exception):
            read_csv(spark, f"file://{path}", ["a", "b"]).collect()


def test_columns(spark):
    df = spark.createDataFrame([("  ", "2020-3-5", "1.005", "  Sant'Ana   do-Livramento "), ("  x", "2020", "x", "São Valério"), (None, "0001-01-01", "-1", None)], "a string, b string, c string, d string")
    got = df.select(X.text("a"), X.date("b"), X.number("c"), X.name_key("d")).collect()
    assert [tuple(r) for r in got] == [(None, date(2020, 3, 5), Decimal("1.01"), "SANT ANA DO LIVRAMENTO"), ("x", None, None, "SAO VALERIO"), (None, None, Decimal("-1.00"), None)]
    codes = spark.createDataFrame([(c,) for c in ("4120400", "0111301", "3511501", "8610101", "9900800", None, "", "x", "4", "0400000", "9800000")], "c string")
    assert [r[0] for r in codes.select(X.section(F.col("c"), 2)).collect()] == ["F", "A", "D", "Q", "U"] + [None] * 6
    bands = spark.createDataFrame([(-1.0,), (69.9,), (70.0,), (5000.0,), (None,)], "a double")
    assert [r[0] for r in bands.select(X.area_band(F.col("a"))).collect()] == [D.AREA_BANDS[0][2]] * 2 + [D.AREA_BANDS[1][2], D.AREA_BANDS[4][2], None]


def test_location_codes(spark):
    df = spark.createDataFrame([(c,) for c in ("584FPC38+X8", " '58pj64q5+jp", None, "", "00000000+00", "httpsplu+sc", "3164704", "URBANO", "RF8J+VH", "584FPC38+X8\n")], "c string")
    lat, lon = olc.decode(olc.normal(F.col("c")))
    lat2, lon2 = olc.recover(olc.normal(F.col("c")), F.lit(-27.17), F.lit(-51.50))
    got = df.select(lat, lon, lat2, lon2).collect()
    assert abs(got[0][0] + 27.29506) < 1e-4 and abs(got[0][1] + 50.58419) < 1e-4 and abs(got[1][0] + 15.76094) < 1e-4
    assert all(r[0] is None for r in got[2:]) and abs(got[8][2] + 27.18281) < 1e-4 and abs(got[8][3] + 51.51856) < 1e-4 and got[0][2] is None


class _Server(BaseHTTPRequestHandler):
    data, cut = b"", 0

    def do_HEAD(self):
        self.send_response(200)
        self._head(len(self.data))

    def _head(self, n):
        for k, v in {"Content-Length": n, "ETag": '"1"', "Last-Modified": "Sat, 12 Sep 2026 10:00:00 GMT"}.items():
            self.send_header(k, str(v))
        self.end_headers()

    def do_GET(self):
        at = int((self.headers.get("Range") or "bytes=0-").split("=")[1].split("-")[0])
        probe = self.headers.get("Range") == "bytes=0-0"
        body = self.data[:1] if probe else self.data[at:]
        self.send_response(206 if self.headers.get("Range") else 200)
        self._head(len(body))
        if not probe and type(self).cut:
            type(self).cut -= 1
            body = body[: len(body) // 2]
        self.wfile.write(body)

    def log_message(self, *_):
        pass


def test_extract_resumes_and_is_idempotent(tmp_path):
    path = tmp_path / "p.zip"
    with zipfile.ZipFile(path, "w") as z:
        for name, data in registry.package().items():
            z.writestr(name, data)
    _Server.data, _Server.cut = path.read_bytes(), 1
    with ThreadingHTTPServer(("127.0.0.1", 0), _Server) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        s = pipeline.Settings(tmp_path / "data", f"http://127.0.0.1:{server.server_port}/p.zip", backoff=0.1)
        first = pipeline.extract(s)
        assert first["snapshot"] == "2026-09-12" and first["totals"] == {"cno": 12, "cno_cnaes": 2, "cno_areas": 4, "cno_vinculos": 3}
        assert json.loads(json.dumps(first, default=str)) == pipeline.extract(s)
        server.shutdown()


def test_bad_packages(tmp_path):
    path = tmp_path / "p.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("../out.csv", b"")
    with pytest.raises(SourceError):
        files.unpack(path, tmp_path / "x", ())
    with pytest.raises(SourceError):
        files.unpack(path, tmp_path / "x")


def test_lock(tmp_path):
    with files.lock(tmp_path, "1"), files.lock(tmp_path, "2"), pytest.raises(files.Locked), files.lock(tmp_path, "1"):
        pass
