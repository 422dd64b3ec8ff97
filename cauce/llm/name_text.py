"""Reading one name of a company or person, as typed, into its parts."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from cauce.llm.edits import deletions, osa
from cauce.llm.places import plain

# Legal forms and phrases that do not tell companies apart (matched as whole words, longest first).
PHRASES = [
    "SOCIEDAD POR ACCIONES SIMPLIFICADA", "SOCIEDAD ANONIMA", "SOCIEDAD LIMITADA", "EMPRESA UNIPERSONAL", "EN LIQUIDACION", "EN REORGANIZACION", "Y CIA", "Y COMPANIA", "E HIJOS", "Y HERMANOS",
    "SUCURSAL NORTE", "SUCURSAL SUR", "SEDE PRINCIPAL", "SEDE NORTE", "SEDE SUR", "S A S", "S A", "E U", "SAS", "SA", "EU", "LTDA", "LIMITADA", "SCA", "ESAL", "PRINCIPAL", "SUCURSAL", "SEDE",
]

# Trade words with their usual short forms.
TRADES = {
    "FERRETERIA": ["FERR", "FERRET"], "RESTAURANTE": ["REST", "RTE", "RESTAURANT"], "DROGUERIA": ["DROG", "DROGERIA"], "COMERCIALIZADORA": ["COM", "COMERC", "CIALIZADORA", "CIAL"],
    "DISTRIBUIDORA": ["DIST", "DISTRIB"], "CONSTRUCTORA": ["CONST", "CONSTR"], "INVERSIONES": ["INV", "INVERS", "INVERCIONES"], "HOTEL": ["HTL"], "TRANSPORTES": ["TRANS", "TRANSP", "TPTES"],
    "PANADERIA": ["PAN", "PANAD"], "CLINICA": ["CLIN"], "ALMACEN": ["ALM", "ALMC"], "COLEGIO": ["COL", "COLEG"], "TALLER": ["TLLR", "TALLERES"], "SERVICIOS": ["SERV", "SVCS"],
    "CONFECCIONES": ["CONF", "CONFEC"], "TECNOLOGIA": ["TEC", "TECNO"], "ASESORIAS": ["ASES"], "AGROPECUARIA": ["AGRO", "AGROP"], "TIENDA": ["TDA"], "BOUTIQUE": [], "INGENIERIA": ["ING"],
    "MISCELANEA": ["MISC"], "PASTELERIA": [], "CAFE": [], "BAR": [], "SPA": [], "INMOBILIARIA": [], "CENTRO": [], "EMPRESA": [], "SOCIEDAD": [], "GRUPO": [], "COMPANIA": ["CIA"],
}

# Given names with their usual familiar forms.
GIVEN = {
    "DOLORES": ["LOLA"], "RAFAEL": ["RAFA"], "BEATRIZ": ["BETTY"], "EDUARDO": ["EDU", "LALO"], "IGNACIO": ["NACHO"], "ROSARIO": ["CHARO"], "ALEJANDRO": ["ALEJO", "ALEX"], "GUADALUPE": ["LUPE", "LUPITA"],
    "MARIA": ["MA", "MARI"], "FRANCISCO": ["PACHO", "PACO", "FCO"], "GABRIEL": ["GABO"], "MERCEDES": ["MECHE"], "MANUEL": ["MANOLO"], "JOSE": ["PEPE", "JO"], "ENRIQUE": ["QUIQUE"],
    "CONSUELO": ["CHELO"], "TERESA": ["TERE"], "ISABEL": ["CHAVELA", "ISA"],
}

#: What is left of a letter whose two UTF-8 bytes were read as two characters, after accents were dropped.
_MISREAD = re.compile("A\u0303?([\x80-\xbf])")
_OTHER = re.compile(r"[^A-Z0-9]+")
_ANY_DIGIT = re.compile(r"\d")
_DIGITS = str.maketrans("0134589", "OIEASBG")
_PHRASE = re.compile(r"(?<![A-Z0-9])(?:" + "|".join(re.escape(p).replace(r"\ ", r"\s+") for p in sorted(PHRASES, key=len, reverse=True)) + r")(?![A-Z0-9])")
_TRADE = {w: k for k, short in TRADES.items() for w in [k, *short]}
_GIVEN = {w: k for k, short in GIVEN.items() for w in [k, *short]}
_JOIN = {"Y", "E", "DE", "DEL", "LA", "EL", "LOS", "LAS", "EN", "POR", "THE"}
#: A part that tells names apart has at least so many letters; shorter ones are pieces of a broken part.
SHORTEST = 5


def _cuts(listed: dict[str, str]) -> dict[str, set[str]]:
    """Full words by themselves with one letter left out, and the longer ones by their ends."""
    out: dict[str, set[str]] = {}
    for full in set(listed.values()):
        for cut in {*deletions(full, 1), *({full[:4] + "~", "~" + full[-4:]} if len(full) >= 9 else set())}:
            out.setdefault(cut, set()).add(full)
    return out


def _near(word: str, cuts: dict[str, set[str]]) -> list[str]:
    """Listed full words that share a text with one letter left out, or an end, with ``word``."""
    near: set[str] = set()
    for i in range(len(word)):
        cut = word[:i] + word[i + 1 :]
        if cut in cuts:
            near |= cuts[cut]
    for cut in (word, word[:4] + "~", "~" + word[-4:]):
        if cut in cuts:
            near |= cuts[cut]
    return sorted(near)


@dataclass
class Name:
    core: list[str] = field(default_factory=list)  # the parts that tell names apart, as written, in order
    trade: str | None = None
    given: list[str] = field(default_factory=list)
    initials: str = ""


_CUTS = _cuts(_TRADE | _GIVEN)
_words: dict[str, tuple[str | None, str | None]] = {}


def _word(word: str) -> tuple[str | None, str | None]:
    """``(trade, given name)`` that a word stands for: listed, one edit from a full word, or two from a long one."""
    if word not in _words:
        if len(_words) > 500_000:
            _words.clear()
        given, trade = _GIVEN.get(word), _TRADE.get(word)
        if not given and not trade and len(word) >= 5:
            close = [full for full in _near(word, _CUTS) if osa(word, full, 2) <= (2 if len(full) >= 9 else 1)]
            given = next((full for full in close if full in GIVEN), None)
            trade = next((full for full in close if full in TRADES), None)
        _words[word] = (None if given else trade, given)
    return _words[word]


def parse(text: str | None) -> Name:
    """The parts of a name. Null or blank texts give a name without parts."""
    name = Name()
    if not text:
        return name
    t = plain(text)
    if not t.isascii():
        t = _MISREAD.sub(lambda m: plain(chr(ord(m[1]) + 0x40)), t)
    t = _OTHER.sub(" ", t).strip()
    t = _PHRASE.sub(" ", t)
    words = t.split() if not _ANY_DIGIT.search(t) else [w if w.isdigit() else w.translate(_DIGITS) for w in t.split()]
    broken = ""
    for w in words:
        trade, given = _word(w)
        if trade:
            name.trade = name.trade or trade
        elif given:
            name.given.append(given)
        elif len(w) == 1:
            if w.isalpha() and w not in "YE":
                name.initials += w
            continue
        elif w in _JOIN or w.isdigit():
            continue
        elif len(w) < SHORTEST:
            if broken:
                name.core.append(broken + w)
                broken = ""
            else:
                broken = w
                if name.core and len(name.core) >= 2:  # a tail cut off the part before
                    name.core[-1] += w
                    broken = ""
            continue
        else:
            name.core.append(broken + w)
            broken = ""
            continue
        broken = ""
    if broken and name.core:
        name.core[-1] += broken
    elif broken:
        name.core.append(broken)
    return name
