"""Rules on inbound messages: safety first, then the surest intent; keyword tables only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cauce.functions.registry import entities

# What is never handled by a machine, in order of precedence: intent, reason and the texts that show it.
SAFETY = [
    ("otp_codigo", "OTP/código de verificación detectado — nunca procesar", ["otp", "código de verificación", "código sms", "pin", "código de autenticación"]),
    ("credenciales", "Credencial detectada — nunca procesar ni almacenar", ["contraseña", "password", "clave de acceso", "usuario y clave", "credencial"]),
    ("documentos_identidad", "Documento de identidad detectado — nunca procesar", ["cédula", "cedula", "foto de cédula", "foto de cedula", "documento de identidad", "pasaporte"]),
]
THIRD_PARTY = ("documentos_identidad", "Documento de tercero detectado — KYC requerido", ["número de documento", "tercero"])

# Intents with their confidence and keywords; of equal confidence the earlier one goes first.
INTENTS = {
    "interes_comercial": (0.95, ["interesado", "quiero información", "me interesa", "cómo funciona", "precios", "costos", "comisiones", "demo", "prueba"]),
    "saludo": (0.9, ["hola", "buenos días", "buenas tardes", "buenas", "qué tal", "saludos"]),
    "objecion_precio": (0.8, ["muy caro", "caro", "costoso", "comisión alta", "comisión muy alta", "no tengo presupuesto"]),
    "ya_tiene_proveedor": (0.85, ["ya tengo", "ya uso", "trabajo con", "mi proveedor", "ya tengo pos", "ya tengo datáfono"]),
    "solicita_demo": (0.9, ["demo", "demostración", "quiero ver", "me pueden mostrar", "prueba gratis"]),
    "erp_integracion": (0.9, ["erp", "sap", "oracle", "integración", "api", "conectar con", "sistema contable", "facturación electrónica"]),
    "otp_codigo": (0.95, ["otp", "código", "código de verificación", "código sms", "pin", "clave", "autenticación", "verificación"]),
    "credenciales": (0.95, ["contraseña", "password", "clave", "usuario y clave", "login", "acceso"]),
    "documentos_identidad": (0.95, ["cédula", "cedula", "documento", "identidad", "foto de cédula", "cc", "pasaporte"]),
    "queja_soporte": (0.8, ["problema", "error", "no funciona", "falla", "queja", "reclamo", "soporte técnico"]),
    "despedida": (0.9, ["gracias", "adiós", "hasta luego", "nos vemos", "chau", "bye"]),
}
UNKNOWN = "desconocido"

# Risk, whether a person approves, and why, by intent.
RISKS = {
    "erp_integracion": ("HIGH", True, "Integración técnica/ERP requiere escalamiento a humano"),
    "otp_codigo": ("CRITICAL", True, "Regla de seguridad dura: nunca procesar automáticamente"),
    "credenciales": ("CRITICAL", True, "Regla de seguridad dura: nunca procesar automáticamente"),
    "documentos_identidad": ("CRITICAL", True, "Regla de seguridad dura: nunca procesar automáticamente"),
    "objecion_precio": ("MEDIUM", False, None),
    "ya_tiene_proveedor": ("MEDIUM", False, None),
    "solicita_demo": ("LOW", True, "Demo requiere aprobación humana antes de agendar"),
    "interes_comercial": ("LOW", True, "Demo requiere aprobación humana antes de agendar"),
    "queja_soporte": ("MEDIUM", True, "Queja/soporte requiere escalamiento a humano"),
}


def _first(text: Column, words: list[str]) -> Column:
    """The place, from 1, of the first of the words that a text contains; 0 for none."""
    return F.array_position(F.transform(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w)), F.lit(True))


def _at(values: list, place: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), place.cast("int") - 1)


def safety(low: Column) -> Column:
    """MSG-1: the number of the first rule of safety that a lower-case text breaks, from 1; 0 for none."""
    rule = F.coalesce(_at([k for k, (_, _, words) in enumerate(SAFETY, 1) for _ in words], _first(low, [w for _, _, words in SAFETY for w in words])), F.lit(0))
    both = reduce(lambda a, b: a & b, [F.contains(low, F.lit(w)) for w in THIRD_PARTY[2]])
    return F.when(rule > 0, rule).when(both, len(SAFETY) + 1).otherwise(0)


_RULES = [*SAFETY, THIRD_PARTY]
_BY_CONFIDENCE = sorted(INTENTS.items(), key=lambda x: -x[1][0])
_WORDS = [(w, name, confidence) for name, (confidence, words) in _BY_CONFIDENCE for w in words]


def intent(low: Column) -> Column:
    """MSG-2: the place among all keywords, surest intents first, of the first one that occurs in a lower-case text; 0 for none."""
    return _first(low, [w for w, _, _ in _WORDS])


def risk(name: Column) -> Column:
    """MSG-3: ``riesgo, requiere_aprobacion, motivo`` of an intent."""
    out = None
    for k, (level, approval, why) in RISKS.items():
        hit = F.struct(F.lit(level).alias("riesgo"), F.lit(approval).alias("requiere_aprobacion"), F.lit(why).cast("string").alias("motivo"))
        out = F.when(name == k, hit) if out is None else out.when(name == k, hit)
    return out.otherwise(F.struct(F.lit("LOW").alias("riesgo"), F.lit(False).alias("requiere_aprobacion"), F.lit(None).cast("string").alias("motivo")))


def classified(messages: DataFrame) -> DataFrame:
    """MSG-1, 2, 3, 5: ``messages`` (with ``text``) and ``intent, confianza, palabra, riesgo, requiere_aprobacion, motivo, entidades``; null texts have nulls.

    Rules of safety go before intents, the surest intent before others, the earlier of equals.
    """
    known = F.col("text").isNotNull()
    # made lower case once, not once for every keyword
    read = messages.withColumn("_low", F.lower("text")).withColumns({"_rule": safety(F.col("_low")), "_word": intent(F.col("_low"))}).drop("_low")
    danger = F.col("_rule") > 0
    wished = read.withColumn("_wish", F.coalesce(_at([name for _, name, _ in _WORDS], F.col("_word")), F.lit(UNKNOWN)))
    usual = risk(F.col("_wish"))
    out = wished.withColumns({
        "intent": F.when(danger, _at([r[0] for r in _RULES], F.col("_rule"))).otherwise(F.col("_wish")), "confianza": F.when(danger, 1.0).otherwise(F.coalesce(_at([c for _, _, c in _WORDS], F.col("_word")), F.lit(0.0))),
        "palabra": F.when(~danger, _at([w for w, _, _ in _WORDS], F.col("_word"))), "riesgo": F.when(danger, "CRITICAL").otherwise(usual["riesgo"]), "requiere_aprobacion": danger | usual["requiere_aprobacion"],
        "motivo": F.coalesce(_at([r[1] for r in _RULES], F.col("_rule")), usual["motivo"]), "entidades": entities(F.col("text")),
    }).drop("_rule", "_word", "_wish")
    made = ["intent", "confianza", "palabra", "riesgo", "requiere_aprobacion", "motivo", "entidades"]
    return out.withColumns({c: F.when(known, F.col(c)) for c in made})
