import numpy as np
from pyspark.sql import functions as F

from cauce.llm import linkage

ENTITY = "entidad_dedup_id string, nit string, razon_social_normalizada string, direccion_comercial string, municipio_comercial string, departamento string, telefono_comercial_1 string, telefono_comercial_2 string, email_comercial string"
INTERNAL = "internal_order bigint, nit string, razon_social string, municipio string, direccion string, telefono string, correo string"


def test_label_model_finds_the_two_classes():
    """Votes drawn from two known classes, two of them correlated: held-out truth is recovered."""
    rng = np.random.default_rng(1)
    truth = rng.random(6000) < 0.25
    votes = np.empty((6000, 6), dtype=int)
    for k in range(6):
        p = np.where(truth[:, None], [0.08, 0.3, 0.62], [0.6, 0.33, 0.07])
        votes[:, k] = (rng.random((6000, 1)) > np.cumsum(p, 1)[:, :2]).sum(1) - 1
    votes[:, 5] = np.where(rng.random(6000) < 0.9, votes[:, 4], votes[:, 5])
    patterns, at, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = linkage.LabelModel(patterns, counts)
    guess = model.posterior()[at.ravel()] > 0.5
    assert (guess == truth).mean() > 0.95 and abs(model.prior - 0.25) < 0.05


def data(spark):
    entities, internal = [], []
    names = [f"{a}{b}{c} {c}{a}{d}" for a, b, c, d in zip(["ZULI", "MOPE", "TARI", "VELO", "GUNA", "PIXA", "DROLE", "SAKI"] * 5, ["NESO", "CHAVI", "LEMBU", "TOGRI", "ROSFE"] * 8, ["KAMI", "JUSE", "FLORA", "QUIBO", "NIDRE", "XATE", "YOLLO"] * 6, ["BEN", "DOR", "SUL"] * 14)]
    for i, n in enumerate(dict.fromkeys(names)):
        entities.append((f"e{i}", str(800000000 + 7919 * i), f"FERRETERIA {n} S.A.S", f"CL {i + 1} # 2-{i + 10}", "ALMIRA", "A", f"3{i:09d}", None, f"info@{n.split()[0].lower()}.co"))
        if i % 2 == 0:
            internal.append((i, str(800000000 + 7919 * i) if i % 4 else None, f"{n[:3]}{n[4:]} ferr ltda", "Almira", f"Calle {i + 1} 2 - {i + 10}", f"+57 3{i:09d}", None))
    entities.append(("nameless", None, None, None, None, None, None, None, None))
    internal += [(900, None, None, None, None, None, None), (901, "222222222", "XILOFONO BAQUELITA", "?", ".", "000", "n/a"), (902, None, "", None, None, None, None)]
    reference = spark.createDataFrame([("91001", "ALMIRA", "A")], "codigo_dane string, nombre string, departamento string")
    return spark.createDataFrame(entities, ENTITY).withColumn("key", F.lit("clash")), spark.createDataFrame(internal, INTERNAL).withColumn("town", F.lit("clash")), reference


def test_matches(spark):
    entities, internal, reference = data(spark)
    got = {(r.entidad_dedup_id, r.internal_order) for r in linkage.matched(entities, internal, reference).filter("confianza >= 0.5").collect()}
    wanted = {(f"e{r.internal_order}", r.internal_order) for r in internal.filter("internal_order < 900").collect()}
    assert got == wanted


def test_a_key_of_many_rows_proposes_all_of_them(spark):
    """A company of 210 entities and a name of one part: no other key, and copies besides."""
    entities, internal, reference = data(spark)
    many = [(f"m{i}", None, "PANADERIA FAMIDADRE", f"CL {500 + i // 2} # 3-1", "ALMIRA", "A", None, None, None) for i in range(210)]
    entities = entities.unionByName(spark.createDataFrame(many, ENTITY).withColumn("key", F.lit("clash")))
    internal = internal.unionByName(spark.createDataFrame([(k, None, "Panaderia Famidadre", None, None, None, None) for k in (950, 951)], INTERNAL).withColumn("town", F.lit("clash")))
    got = linkage.matched(entities, internal, reference).filter("internal_order in (950, 951)").collect()
    assert sorted((r.entidad_dedup_id, r.internal_order) for r in got) == sorted((m[0], k) for m in many for k in (950, 951))
    assert all(r.v_part == 1 and r.v_name == 1 for r in got)


def test_different_names_match_only_if_something_vouches():
    """The belief enters the model: the posterior itself turns such pairs down, whatever else agrees."""
    votes = linkage.VOTES
    v = lambda **k: [k.get(name, 0) for name in votes]
    patterns = [
        v(v_name=1, v_part=1, v_nit=1, v_place=1, v_kind=1), v(v_name=1, v_part=1, v_place=1, v_kind=1), v(v_name=1, v_part=1, v_email=1, v_place=1, v_kind=1), v(v_name=-1, v_part=1, v_email=1, v_place=1, v_kind=1, v_vouch=-1),
        v(v_name=-1, v_part=1, v_nit=1, v_place=1, v_kind=1, v_vouch=1), v(v_name=-1, v_part=-1, v_nit=-1, v_place=-1, v_kind=-1, v_vouch=-1), v(v_name=-1, v_part=1, v_place=-1, v_kind=-1, v_vouch=-1),
    ]
    for scale in (1, 1000):
        counts = np.array([300, 700, 300, 60, 20, 500, 300]) * scale
        got = linkage.LabelModel(np.array(patterns), counts, beliefs=linkage.believed(votes, float(counts.sum()))).posterior()
        assert (got[[0, 1, 2, 4]] > 0.9).all() and (got[[3, 5, 6]] < 0.1).all()


def test_calibration(spark):
    entities, internal, reference = data(spark)
    got = linkage.calibration(entities, internal, reference).collect()
    assert all(0 <= r.decil <= 9 and r.pares > 0 for r in got) and next(r for r in got if r.decil == 9).acuerdo > 0.9
    assert linkage.calibration(entities.limit(0), internal, reference).count() == 0


def test_nothing_to_match(spark):
    entities, internal, reference = data(spark)
    assert linkage.matched(entities.limit(0), internal, reference).count() == 0
    assert linkage.matched(entities, internal.limit(0), reference).count() == 0
