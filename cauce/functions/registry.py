"""Expressions on registry values: codes, sizes, years, identifiers, comparable names. All inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cauce.functions.text import comparison_text, digits

# Commercial sector by section letter of the activity code, and by exact code where that is finer.
SECTIONS = {
    "A": "Agro", "B": "Minería", "C": "Manufactura", "D": "Servicios públicos", "E": "Servicios públicos", "F": "Construcción", "G": "Comercio / Retail", "H": "Transporte y logística",
    "I": "Gastronomía y Hotelería", "J": "Tecnología / Comunicaciones", "K": "Financiero / Seguros", "L": "Inmobiliario", "M": "Servicios profesionales", "N": "Servicios de apoyo empresarial",
    "O": "Sector público", "P": "Educación", "Q": "Salud", "R": "Entretenimiento", "S": "Otros servicios", "T": "Hogares", "U": "Extraterritorial",
}
EXACT_CODES = {"G4773": "Salud / Farmacias", "G4752": "Ferretería y construcción menor"}
# How well the sections fit, and the exact codes.
SECTION_FIT = {
    "A": "bajo", "B": "no_aplica", "C": "medio", "D": "no_aplica", "E": "no_aplica", "F": "bajo", "G": "alto", "H": "medio", "I": "alto", "J": "medio", "K": "bajo", "L": "bajo", "M": "medio", "N": "medio", "O": "no_aplica",
    "P": "medio", "Q": "alto", "R": "alto", "S": "medio", "T": "no_aplica", "U": "no_aplica",
}
EXACT_FIT = {"G4773": "alto", "G4752": "alto"}

# Declared company sizes (texts after comparison normalisation), and the employees up to which a size is inferred.
DECLARED_SIZES = {"MICRO": "micro", "MICROEMPRESA": "micro", "MICRO EMPRESA": "micro", "MEDIANA": "mediana", "MEDIANA EMPRESA": "mediana", "GRANDE": "grande", "GRAN EMPRESA": "grande"}
SIZE_LIMITS = [(10, "micro"), (50, "pequeña"), (200, "mediana")]

# Years of renewal that are plausible, and the number of employees that is not.
YEARS = (1990, 2026)
ABSURD_EMPLOYEES = 100_000

# Weights of the official check digit, for a base padded to 15 digits.
CHECK_WEIGHTS = [71, 67, 59, 53, 47, 43, 41, 37, 29, 23, 19, 17, 13, 7, 3]
QUERY_ID_LENGTHS = (7, 12)

# States appended to company names, and legal forms with their short form (the first that changes the name is used).
STATE_SUFFIXES = ["EN LIQUIDACION JUDICIAL", "EN LIQUIDACION", "EN REESTRUCTURACION", "EN REORGANIZACION", "EN CONCORDATO"]
LEGAL_FORMS = [(r"\bS\.?\s*A\.?\s*S\.?\s*$", "SAS"), (r"\bLTDA\.?\s*$", "LTDA"), (r"\bE\.?\s*U\.?\s*$", "EU"), (r"\bS\.?\s*A\.?\s*$", "SA")]
NAME_PUNCTUATION = r"[.,;:'\"()]"

# Shares of the diversified ranking.
SHARE_FACTOR, SHARE_MARGIN, SMOOTHING = 3.0, 0.10, 22.0
SECTOR_SHARES, PLACE_SHARES = (0.25, 0.50, 0.55), (0.15, 0.35, 0.45)
SECTOR_BUCKETS = {
    "Gastronomía y Hotelería": "HORECA", "Ferretería y construcción menor": "Ferretería", "Salud": "Salud", "Salud / Farmacias": "Salud/Farmacias", "Educación": "Educación", "Comercio / Retail": "Comercio/Retail",
    "Manufactura": "Manufactura", "Otros servicios": "Servicios", "Servicios profesionales": "Servicios", "Servicios de apoyo empresarial": "Servicios", "Servicios públicos": "Servicios",
    "Tecnología / Comunicaciones": "Tecnología", "Entretenimiento": "Entretenimiento", "Transporte y logística": "Transporte/logística",
}


def lookup(c: Column, table: dict[str, str]) -> Column:
    """The entry of a small fixed table; null where there is none."""
    return F.get(F.array(*[F.lit(v) for v in table.values()]), F.array_position(F.array(*[F.lit(k) for k in table]), c).cast("int") - 1)


def activity(c: Column) -> Column:
    """ENR-1: ``seccion, codigo, sector, encaje, nota`` of an activity code; the exact code goes before its section.

    ``nota`` says why there is no sector; it is null where there is one.
    """
    text = F.upper(F.trim(c))
    section, number = F.regexp_extract(text, r"^([A-Z])(\d{3,4})", 1), F.regexp_extract(text, r"^([A-Z])(\d{3,4})", 2)
    coded = text.rlike(r"^[A-Z]\d{3,4}")
    code = F.concat(section, number)
    sector = F.when(coded, F.coalesce(lookup(code, EXACT_CODES), lookup(section, SECTIONS)))
    note = F.when(c.isNull() | (c == ""), "Sin código CIIU").when(~coded, F.format_string("No se reconoce el formato CIIU: '%s'", F.substring(text, 1, 20))).when(sector.isNull(), F.format_string("Sección CIIU '%s' no mapeada", section))
    return F.struct(
        F.when(coded, section).alias("seccion"), F.when(coded, code).alias("codigo"), sector.alias("sector"),
        F.when(coded, F.coalesce(lookup(code, EXACT_FIT), lookup(section, SECTION_FIT))).alias("encaje"), note.alias("nota"),
    )


def company_size(declared: Column, employees: Column) -> Column:
    """ENR-2: ``tamano, metodo, confianza``: declared if the label is known, else inferred from whole employees."""
    known = lookup(comparison_text(declared), DECLARED_SIZES)
    number = F.when(F.trim(employees).rlike(r"^[+-]?\d{1,18}$"), F.trim(employees).cast("bigint"))
    inferred = F.lit("grande")
    for limit, label in reversed(SIZE_LIMITS):
        inferred = F.when(number <= limit, label).otherwise(inferred)
    return (
        F.when(known.isNotNull(), F.struct(known.alias("tamano"), F.lit("declarado_por_fuente").alias("metodo"), F.lit("confirmado").alias("confianza")))
        .when(number.isNotNull(), F.struct(inferred.alias("tamano"), F.lit("inferido_por_empleados").alias("metodo"), F.lit("inferido").alias("confianza")))
        .otherwise(F.struct(F.lit("sin_dato").alias("tamano"), F.lit("sin_senal_disponible").alias("metodo"), F.lit("inferido").alias("confianza")))
    )


def size_class(c: Column) -> Column:
    """SCO-3: size by the word it contains, the larger going first."""
    text = F.replace(F.lower(c), F.lit("ñ"), F.lit("n"))
    return F.when(text.contains("gran"), "grande").when(text.contains("median"), "mediana").when(text.contains("pequen"), "pequeña").when(text.contains("micro"), "micro")


def contact_channels(phones: list[Column], mail: Column) -> Column:
    """SCO-7: 0 to 2: whether there is any telephone, and a mail address; empty texts count as there."""
    return F.coalesce(*phones).isNotNull().cast("int") + mail.isNotNull().cast("int")


def weighted_mean(parts: list[tuple[Column, float]]) -> Column:
    """SCO-8: mean of the values that are there by their weights; a missing value leaves both sums. Null if none is there."""
    total = sum((F.when(v.isNotNull(), v * w).otherwise(0.0) for v, w in parts), F.lit(0.0))
    weight = sum((F.when(v.isNotNull(), w).otherwise(0.0) for v, w in parts), F.lit(0.0))
    return F.when(weight > 0, total / weight)


def renewal_year(c: Column) -> Column:
    """SCO-4: four digits once points and commas are dropped, within the plausible years."""
    text = F.regexp_replace(F.translate(c, ",.", ""), r"(?U)^\s+|\s+$", "")
    year = F.when(text.rlike(r"^\d{4}$"), text.cast("int"))
    return F.when(year.between(*YEARS), year)


def plausible_employees(c: Column) -> Column:
    """ENR-6: ``valor, anomalo``: whole numbers from 100,000 are dropped and flagged."""
    number = F.when(c.rlike(r"^\d+$"), c.try_cast("decimal(38,0)"))
    absurd = F.coalesce(number >= ABSURD_EMPLOYEES, c.rlike(r"^\d{39,}$"), F.lit(False))
    return F.struct(F.when(~absurd, c).alias("valor"), absurd.alias("anomalo"))


def check_digit(base: Column) -> Column:
    """LEG-1: the official check digit of a base of up to 15 digits."""
    figures = F.split(F.lpad(base, 15, "0"), "")
    terms = F.zip_with(figures, F.array(*[F.lit(w) for w in CHECK_WEIGHTS]), lambda figure, w: F.coalesce(figure.try_cast("int"), F.lit(0)) * F.coalesce(w, F.lit(0)))
    return F.aggregate(terms, F.lit(0), lambda a, b: a + b, lambda total: F.get(F.array(*[F.lit(str(r if r <= 1 else 11 - r)) for r in range(11)]), total % 11))


def askable_id(c: Column) -> Column:
    """LEG-2: ``base, digito, consultable`` of a tax id, without computing its check digit."""
    clean = digits(c)
    usable = F.coalesce(F.length(clean).between(*QUERY_ID_LENGTHS), F.lit(False))
    return F.struct(F.when(usable, F.substring(clean, F.lit(1), F.length(clean) - 1)).alias("base"), F.when(usable, F.substring(clean, -1, 1)).alias("digito"), usable.alias("consultable"))


def query_id(c: Column) -> Column:
    """LEG-2: ``base, digito, calculado, coincide, consultable`` of a tax id of 7 to 12 digits."""
    clean = digits(c)
    usable = F.coalesce(F.length(clean).between(*QUERY_ID_LENGTHS), F.lit(False))
    base = F.when(usable, F.substring(clean, F.lit(1), F.length(clean) - 1))
    last = F.when(usable, F.substring(clean, -1, 1))
    computed = F.when(usable, check_digit(base))
    return F.struct(base.alias("base"), last.alias("digito"), computed.alias("calculado"), (last == computed).alias("coincide"), usable.alias("consultable"))


def comparable_name(c: Column) -> Column:
    """LEG-3: a name for comparison: one appended state off, one legal form shortened, punctuation as space."""
    # the end of a name matches at most one state and one legal form, so the patterns can be applied in turn
    bare = F.trim(F.regexp_replace(comparison_text(c), "(?:" + "|".join(STATE_SUFFIXES) + ")$", ""))
    for pattern, short in LEGAL_FORMS:
        bare = F.regexp_replace(bare, pattern, short)
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(bare, NAME_PUNCTUATION, " "), r"\s+", " ")), F.lit(""))


def compatible_names(a: Column, b: Column) -> Column:
    """LEG-4: equal once comparable, or one within the other; blank names are not compatible."""
    x, y = comparable_name(a), comparable_name(b)
    return F.coalesce((x == y) | F.contains(x, y) | F.contains(y, x), F.lit(False))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def smoothed_share(count: Column, size: Column, base: Column, m: float = SMOOTHING) -> Column:
    """DIV-6: posterior mean of a category's share once one more is admitted."""
    return (count + 1 + m * base) / (size + 1 + m)


def tie_key(c: Column) -> Column:
    """DIV-3: first 15 hexadecimal digits of SHA-256; as a number they order alike."""
    return F.substring(F.sha2(c, 256), 1, 15)


# What is taken from messages. Letters, digits and white space of any script (U) count.
PHONES = r"(?U)(?:\+57|57)?\s?3\d{9}|\d{7,10}"
EMAILS = r"(?U)[\w\.-]+@[\w\.-]+\.\w+"
AMOUNTS = r"(?iU)\$?\s?\d{1,3}(?:[.,]\d{3})*(?:[.,]\d{2})?\s?(?:COP|pesos|cop)?"


def entities(c: Column) -> Column:
    """MSG-4: ``telefonos, emails, montos`` found in a text, in order."""
    return F.struct(*[F.regexp_extract_all(c, F.lit(p), F.lit(0)).alias(k) for k, p in (("telefonos", PHONES), ("emails", EMAILS), ("montos", AMOUNTS))])
