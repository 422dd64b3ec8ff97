"""Phases from the command line, the polite client, invented entities."""

import json
import random
from urllib.error import HTTPError, URLError

import pytest

from cauce import config
from cauce.__main__ import main, parser
from cauce.operators import legal, reports
from cauce.sources import asking, synthetic


class Script:
    """A transport that plays answers, with a clock of its own."""

    def __init__(self, *answers):
        self.answers, self.now, self.waits = list(answers), 0.0, []

    def __call__(self, key):
        self.now += 0.05
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    def asker(self):
        def sleep(s):
            self.waits.append(s)
            self.now += s

        return asking.Asker(self, sleep=sleep, clock=lambda: self.now, rng=random.Random(1))


OK, AGAIN = asking.Answer("ok", ({"nit": "1"},)), asking.Answer("again", code=503)


def test_retries_and_waits():
    s = Script(AGAIN, AGAIN, OK)
    a = s.asker()
    assert a.ask("1").records and 0.75 <= s.waits[0] <= 1.25 and 1.5 <= s.waits[1] <= 2.5 and [e["numero_intento"] for e in a.events] == [1, 2, 3] and a.events[-1]["resultado_final"] == "EXITO"
    s = Script(AGAIN, AGAIN, AGAIN, OK)
    assert s.asker().ask("1").kind == "again" and len(s.answers) == 1
    s = Script(asking.Answer("never", code=404), OK)
    assert s.asker().ask("1").kind == "never" and not s.waits


def test_limits_of_the_rate():
    s = Script(asking.Answer("again", code=429, retry_after=7.0), OK, OK, OK)
    a = s.asker()
    assert a.ask("1").kind == "ok" and s.waits == [7.0] and a.events[0]["hubo_retry_after"]
    a.ask("2")
    assert s.waits[1] == pytest.approx(0.55)  # wider spacing from now on, less the time the answer took
    s = Script(asking.Answer("again", code=429, retry_after=61.0), OK)
    assert s.asker().ask("1").kind == "again" and len(s.answers) == 1
    s = Script(asking.Answer("again", code=429), OK)
    assert s.asker().ask("1").kind == "ok" and 1.5 <= s.waits[0] <= 2.5
    s = Script(OK, OK)
    a = s.asker()
    a.ask("1"), a.ask("2")
    assert s.waits == [pytest.approx(0.25)]


def test_unreadable_answers_are_asked_for_once_more():
    bad = json.JSONDecodeError("x", "y", 0)
    s = Script(bad, OK)
    assert s.asker().ask("1").kind == "ok"
    s = Script(bad, bad, OK)
    assert s.asker().ask("1").kind == "unreadable" and len(s.answers) == 1


@pytest.mark.parametrize("error,kind", [(TimeoutError(), "again"), (URLError(TimeoutError()), "again"), (ConnectionResetError(), "again"), (ValueError("x"), "never"), (HTTPError("u", 500, "m", {}, None), "again"), (HTTPError("u", 401, "m", {}, None), "never"), (HTTPError("u", 418, "m", {}, None), "never")])
def test_meaning_of_errors(error, kind):
    assert asking.answer_of(error).kind == kind
    assert asking.answer_of(HTTPError("u", 429, "m", {"Retry-After": "5"}, None)).retry_after == 5.0 and asking.answer_of(HTTPError("u", 429, "m", {"Retry-After": "soon"}, None)).retry_after is None


def test_answers_become_a_table(spark):
    def make():
        def transport(key):
            return {"1": asking.Answer("ok", ({"nit": "1", "razon_social": "A", "estado_matricula": "ACTIVA"}, {"nit": "1", "razon_social": "B", "estado_matricula": "CANCELADA"})), "2": asking.Answer("ok")}.get(key) or asking.Answer("never", code=404)

        return asking.Asker(transport, sleep=lambda s: None)

    out = asking.asked(spark.createDataFrame([("3",), ("1",), ("2",)], "nit_consultado string"), make).collect()
    assert [(r.nit_consultado, r.ok, r.orden, r.razon_social, len(r.eventos)) for r in out] == [("1", True, 1, "A", 1), ("1", True, 2, "B", 0), ("2", True, None, None, 1), ("3", False, None, None, 1)]
    answers = {r.nit_consultado: r for r in legal.answers(spark.createDataFrame([r[:-1] for r in out], asking.RESPONSES.rsplit(", eventos", 1)[0])).collect()}
    assert answers["1"].resuelto and answers["1"].registro.razon_social == "A" and answers["2"].n == 0 and not answers["3"].ok


def test_invented_entities(spark):
    one = {r.entidad_dedup_id: r for r in synthetic.entities(spark, 500).collect()}
    again = {r.entidad_dedup_id: r for r in synthetic.entities(spark, 500).repartition(7).collect()}
    assert one == again and len(one) == 500 and {r.entidad_dedup_id: r for r in synthetic.entities(spark, 500, 7).collect()} != one
    assert 400 < sum(r.estado_exclusion == "SIN_COINCIDENCIA" for r in one.values()) < 450


def test_phases(spark, tmp_path, capsys):
    data = tmp_path / "data"
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.csv").write_text("NIT,NOMBRE,MUNICIPIO,CIIU\n900123,Uno,X,G4711\n900123,Uno SAS,X,G4711\n,Dos,Y,I5611\n,,,\n")
    (tmp_path / "c.json").write_text(json.dumps({"fuentes": [{"source_id": "s", "formato": "csv", "ruta": str(tmp_path / "raw" / "a.csv"), "archivo": "a.csv", "categoria": "camara"}], "sinonimos": {"nit": ["NIT"], "razon_social": ["NOMBRE"], "municipio_comercial": ["MUNICIPIO"], "ciiu_1": ["CIIU"]}, "pesos": {"defined": True}}))
    spark.createDataFrame([("s", "a.csv", "csv", "camara", "c")], "source_id string, archivo string, formato string, categoria string, camara_grupo string").write.parquet(str(data / "fuentes.parquet"))
    spark.createDataFrame([(1, "crm", None, None, "dos", "y", None)], "internal_order bigint, fuente_interna string, nit string, matricula string, razon_social string, municipio string, tipo_antecedente string").write.parquet(str(data / "claves_internas.parquet"))
    common, conf = ["--datos", str(data), "--crudos", str(tmp_path / "raw")], ["--config", str(tmp_path / "c.json")]
    for phase, more in (("catalogo", []), ("ingesta", conf), ("normalizar", conf), ("deduplicar", []), ("excluir", ["--camara", "c"]), ("enriquecer", []), ("scorear", conf), ("reportar", ["--top", "10", "--sector", "Comercio / Retail"])):
        main([phase, *common, *more], spark)
    scored = {r.razon_social: r for r in spark.read.parquet(str(data / "empresas_scored.parquet")).collect()}
    assert scored["Uno"].registros_consolidados == 2 and scored["Uno"].score_prioridad_comercial > 0 and scored["Dos"].estado_exclusion == "CANDIDATO_AMBIGUO"
    assert "Uno" in capsys.readouterr().out
    with pytest.raises(reports.ListError):  # one row is all of its sector, which the hard limit forbids
        main(["diversificar", *common, "--n", "1"], spark)
    with pytest.raises(PermissionError):
        main(["deduplicar", "--datos", str(data), "--crudos", str(data)], spark)
    with pytest.raises(SystemExit):
        parser().parse_args(["reportar", "--datos", "x", "--top", "7"])


def test_configuration(tmp_path):
    with pytest.raises(FileNotFoundError):
        config.load(str(tmp_path / "none.json"))
    (tmp_path / "c.json").write_text('{"a": 1}')
    assert config.load(str(tmp_path / "c.json")) == {"a": 1}
