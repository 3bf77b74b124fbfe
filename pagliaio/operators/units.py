"""Quantities written in many units: segment unit strings and convert.

A unit string ("sq.ft.", "yard quadrate", "migliaia di euro al mq") is cut into
prefixes, roots and exponents by dynamic programming over a trie of their
spellings. Every segment costs, characters that belong to nothing cost more, and
the dimension of the field (a surface, a price per surface) decides between
readings that spell alike: ``ca`` is *circa* before a figure that has a unit and
*centiara* where a surface needs one; ``a`` is *are* in a surface and a
preposition in a price.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Spellings with their class and size in metres or square metres.
PREFIXES = {"k": 1e3, "mila": 1e3, "migliaia di": 1e3, "migliaia": 1e3, "mille": 1e3, "k.": 1e3, "mln": 1e6, "milioni di": 1e6}
LENGTHS = {
    "m": 1.0, "mt": 1.0, "metro": 1.0, "metri": 1.0, "meter": 1.0, "meters": 1.0, "metre": 1.0, "metres": 1.0, "quadratmeter": 1.0,
    "cm": 0.01, "dm": 0.1, "km": 1000.0,
    "ft": 0.3048, "foot": 0.3048, "feet": 0.3048, "p": 0.3048, "piede": 0.3048, "piedi": 0.3048, "f": 0.3048,
    "yd": 0.9144, "yds": 0.9144, "yard": 0.9144, "yards": 0.9144, "iarda": 0.9144, "iarde": 0.9144,
    "in": 0.0254, "inch": 0.0254, "pollice": 0.0254, "pollici": 0.0254,
}
AREAS = {
    "ca": 1.0, "centiara": 1.0, "centiare": 1.0, "sqm": 1.0, "qm": 1.0,
    "a": 100.0, "ar": 100.0, "ara": 100.0, "are": 100.0, "ares": 100.0,
    "ha": 1e4, "ettaro": 1e4, "ettari": 1e4, "hectare": 1e4, "hectares": 1e4, "hektar": 1e4,
    "ac": 4046.8564224, "acre": 4046.8564224, "acres": 4046.8564224, "acro": 4046.8564224, "acri": 4046.8564224,
    "sqft": 0.09290304, "sqyd": 0.83612736, "psf": 0.09290304,
}
POWERS_BEFORE = ["sq", "square"]
POWERS_AFTER = ["²", "2", "^2", "q", "quadro", "quadri", "quadra", "quadre", "quadrato", "quadrati", "quadrata", "quadrate", "quadr", "squared"]
CURRENCIES = ["€", "eur", "euro", "euri", "euros"]
CONNECTORS = ["/", "al", "alla", "all'", "per", "a", "ad", "pro", "each"]
APPROXIMATE = ["ca", "circa", "approx", "about", "c"]
FILLERS = [" ", ".", ",", ";", ":", "(", ")", "[", "]", "-", "'", " ", "e", "di"]

SURFACE, PRICE = "surface", "price"
_COST = {"prefix": 1.0, "length": 1.0, "area": 1.2, "before": 0.8, "after": 0.8, "currency": 0.6, "per": 0.6, "approx": 1.5, "filler": 0.1, "number": 0.5}
_UNKNOWN, _SHORT = 6.0, 0.7


def _build_trie() -> dict:
    trie: dict = {}

    def put(word: str, kind: str, size: float = 1.0) -> None:
        node = trie
        for ch in word:
            node = node.setdefault(ch, {})
        node.setdefault("", []).append((kind, size, len(word)))

    for table, kind in ((PREFIXES, "prefix"), (LENGTHS, "length"), (AREAS, "area")):
        for word, size in table.items():
            put(word, kind, size)
    for words, kind in ((POWERS_BEFORE, "before"), (POWERS_AFTER, "after"), (CURRENCIES, "currency"), (CONNECTORS, "per"), (APPROXIMATE, "approx"), (FILLERS, "filler")):
        for word in words:
            put(word, kind)
    return trie


_TRIE = _build_trie()

#: What may follow what: (state, class) -> state. States end as "area" or "rate".
_STEPS = {
    ("start", "before"): "square", ("start", "length"): "length", ("start", "area"): "area", ("start", "approx"): "start",
    ("square", "length"): "area", ("length", "after"): "area", ("area", "length"): "area", ("area", "approx"): "area",
    ("start", "prefix"): "scaled", ("scaled", "currency"): "money", ("start", "currency"): "money", ("money", "per"): "per", ("per", "per"): "per",
    ("per", "before"): "per-square", ("per", "length"): "per-length", ("per", "area"): "rate", ("money", "before"): "per-square", ("money", "length"): "per-length",
    ("per-square", "length"): "rate", ("per-length", "after"): "rate", ("rate", "number"): "rate-note", ("rate-note", "length"): "rate-note", ("rate-note", "after"): "rate-note",
}
_BOUNDARY = re.compile(r"[a-zà-ù]")


@lru_cache(maxsize=65536)
def parse_unit(text: str, field: str) -> tuple[float, str] | None:
    """(size, name) of the unit: square metres (``surface``) or the factor to euro per square metre (``price``).

    The name tells units of one size apart: ``centiara`` is not ``m²``. None
    where no reading has the dimension of the field. The figure in
    parentheses of "EUR per are (100 mq)" is a remark and changes nothing.
    """
    s = re.sub(r"\s+", " ", text.lower()).strip()
    goal = "area" if field == SURFACE else "rate"
    best: list[dict] = [{} for _ in range(len(s) + 1)]
    best[0]["start"] = (0.0, 1.0, 1.0, "m²")

    def offer(i: int, state: str, value: tuple) -> None:
        if state not in best[i] or value[0] < best[i][state][0]:
            best[i][state] = value

    for i in range(len(s)):
        if not best[i]:
            continue
        inside = i > 0 and _BOUNDARY.match(s[i - 1])
        matches = []
        node, j = _TRIE, i
        while j < len(s) and s[j] in node:
            node = node[s[j]]
            j += 1
            matches += [(kind, size, j) for kind, size, _ in node.get("", ())]
        digits = re.match(r"\d[\d.,]*", s[i:])
        if digits:
            matches.append(("number", 1.0, i + digits.end()))
        for state, (cost, scale, size, name) in list(best[i].items()):
            for kind, factor, j in matches:
                step = state if kind == "filler" else _STEPS.get((state, kind))
                if step is None:
                    continue
                price = _COST[kind]
                if kind not in ("filler", "number"):
                    glued_left, glued_right = inside, j < len(s) and _BOUNDARY.match(s[j])
                    if (glued_left or glued_right) and j - i <= 2 and kind != "after" and not (kind == "prefix" or (state == "square") or (kind == "length" and glued_right)):
                        price += _SHORT * 4
                    if kind == "approx" and state == "start" and field == SURFACE:
                        price += 1.0
                    if glued_right and j - i > 2 and kind not in ("before",):
                        price += _SHORT
                if kind == "filler" and s[i:j].isalpha() and (inside or (j < len(s) and _BOUNDARY.match(s[j]))):
                    continue
                new_scale, new_size, new_name = scale, size, name
                if kind == "prefix":
                    new_scale, new_name = scale * factor, "scaled"
                elif kind == "length" and (state in ("square", "per-square") or step in ("length", "per-length")):
                    new_size, new_name = factor * factor, name if factor == 1.0 else s[i:j] + "²"
                elif kind == "length" and state == "area" and abs(size - factor * factor) > 1e-12:
                    continue  # "p.q. (piedi)": the remark must agree
                elif kind == "area":
                    new_size, new_name = factor, name if s[i:j] in ("sqm", "qm") else s[i:j]
                offer(j, step, (cost + price, new_scale, new_size, new_name))
            offer(i + 1, state, (cost + _UNKNOWN, scale, size, name))
    ends = [v for k, v in best[len(s)].items() if k == goal or (goal == "rate" and k == "rate-note")]
    if not ends:
        return None
    cost, scale, size, name = min(ends)
    if cost >= 2 * _UNKNOWN:
        return None
    return (size, name) if field == SURFACE else (scale / size, name)


_NUMBER = re.compile(r"\d+(?:[.,]\d+)*")


def parse_number(text: str) -> float:
    """``1.819`` and ``1,572`` are thousands, ``0,4541``, ``1.47`` and ``183,2`` decimals."""
    marks = [c for c in text if c in ".,"]
    if not marks:
        return float(text)
    last = marks[-1]
    head, tail = text.rsplit(last, 1)
    if len(set(marks)) == 2:
        return float(re.sub(r"[.,]", "", head) + "." + tail)
    groups = re.split(r"[.,]", text)
    if all(len(g) == 3 for g in groups[1:]) and groups[0] != "0" and len(groups[0]) <= 3:
        return float("".join(groups))
    return float(re.sub(r"[.,]", "", head) + "." + tail)


def parse_surface(text: str) -> tuple[float | None, str | None]:
    """(square metres, unit name); the bare figure and None where no unit is stated."""
    s = re.sub(r"(?<=[a-z])2(?!\d)", "²", text.lower())
    found = list(_NUMBER.finditer(s))
    if not found:
        return None, None
    between = [s[: found[0].start()]] + [s[a.end() : b.start()] for a, b in zip(found, found[1:])] + [s[found[-1].end() :]]
    if len(found) == 1:
        raw = found[0].group()
        after, before = (parse_unit(x, SURFACE) if x.strip() else None for x in (between[1], between[0]))
        unit = after if after is not None else before
        pieces = raw.split(".")
        if unit and unit[0] == 1e4 and len(pieces) == 3 and all(len(p) == 2 for p in pieces[1:]):
            return int(pieces[0]) * 1e4 + int(pieces[1]) * 100.0 + int(pieces[2]), unit[1]  # ha 0.42.04
        value = parse_number(raw)
        return (value * unit[0], unit[1]) if unit else (value, None)
    units = [parse_unit(x, SURFACE) if x.strip() else None for x in between[1:]]
    if all(u is not None for u in units):  # 0 ha 53 are 66 ca
        return sum(parse_number(n.group()) * u[0] for n, u in zip(found, units)), units[0][1]
    value = parse_number(found[0].group())
    return (value * units[0][0], units[0][1]) if units[0] else (value, None)


_LABEL = re.compile(r"(?i)\b(?:sup(?:\.|erficie)?\s+)?comm(?:\.|erciale|\.le|le)\b\.?")
_DECLARED = re.compile(r"(?i)\b(?:misur\w*|superfic\w*|metratur\w*|dimension\w*|size|sizes|area|surface|fl[aä]che)\b[^.;\n\d]{0,40}?\bin\s+([^.;\n\d]{2,40}(?:\.\s?ft\b)?)")


def declared_unit(*texts: str | None) -> tuple[float, str] | None:
    """Unit that a listing's other texts declare for its figures ("Misure in sq ft."), if any."""
    for text in texts:
        for m in _DECLARED.finditer(text or ""):
            unit = parse_unit(m.group(1), SURFACE)
            if unit is not None:
                return unit
    return None


def convert_surfaces(listings: DataFrame) -> DataFrame:
    """``rec, figure, amount, unit, stated``: every stated surface in square metres.

    ``listings`` needs rec, surface_raw, mq, mq_commercial, description, caption
    and title. ``figure`` is ``net`` or ``commercial``; ``stated`` is the unit's
    origin (``text``, ``elsewhere`` or ``none``). A figure without any unit is
    taken as square metres. Where surface_raw is empty the columns mq and
    mq_commercial give the figures. Texts without a number give no row.
    """

    @F.pandas_udf("array<struct<figure:string,amount:double,unit:string,stated:string>>")
    def surfaces(raw: pd.Series, mq: pd.Series, com: pd.Series, description: pd.Series, caption: pd.Series, title: pd.Series) -> pd.Series:
        out = []
        for text, net, weighted, *others in zip(raw, mq, com, description, caption, title):
            figures = []
            if text and text.strip():
                cut = _LABEL.search(text)
                parts = [("net", text[: cut.start()].rstrip(" |") if cut else text)] + ([("commercial", text[cut.end() :])] if cut else [])
                figures = [(name, *parse_surface(part)) for name, part in parts]
            else:
                figures = [(name, None if v is None or v != v else float(v), None) for name, v in (("net", net), ("commercial", weighted))]
            row, other = [], False
            for name, amount, unit in figures:
                if amount is None:
                    continue
                stated = "text"
                if unit is None:
                    other = declared_unit(*others) if other is False else other
                    (size, unit), stated = (other, "elsewhere") if other else ((1.0, "m²"), "none")
                    amount *= size
                row.append({"figure": name, "amount": amount, "unit": unit, "stated": stated})
            out.append(row)
        return pd.Series(out)

    cells = surfaces("surface_raw", "mq", "mq_commercial", "description", "caption", "title")
    return listings.select("rec", "surface_raw", F.explode(cells).alias("c")).select("rec", "surface_raw", "c.*")


_BASIS = re.compile(r"(?i)^\s*(?:n|l|netta|lorda)\b[\s,:-]*")


def convert_prices(bands: DataFrame) -> DataFrame:
    """Bands with ``factor`` (to euro per square metre) and both bounds converted as doubles.

    The unit stands in ``surface_basis`` behind the basis letter; without one, or
    with NULL, the bounds are per square metre. NULL bounds stay NULL.
    """

    @F.pandas_udf("double")
    def factor(basis: pd.Series) -> pd.Series:
        rests = [_BASIS.sub("", text or "").strip() for text in basis]
        return pd.Series([(parse_unit(rest, PRICE) or (1.0,))[0] if rest else 1.0 for rest in rests], dtype="float64")

    return (
        bands.withColumn("factor", factor("surface_basis"))
        .withColumn("min_converted", F.col("min_eur_m2") * F.col("factor"))
        .withColumn("max_converted", F.col("max_eur_m2") * F.col("factor"))
    )
