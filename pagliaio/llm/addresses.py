"""Postal addresses that denote one place: parsing, MinHash banding, affine-gap alignment.

An address is cut into comune, house number with suffix, street type and street
words. Two addresses can only denote one place where comune, number and suffix are
equal, so these lead every band key; the band itself comes from MinHash values of
the q-grams of one street word, for each word of its own, and from whole words.
Candidates are verified by aligning the street words with affine gaps; what a
substitution costs depends on typos, initials, numerals and a dictionary of
abbreviations.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagliaio.session import cut_lineage
from pagliaio.tables import small_enough

# Street types by spelling. "loc" and "fraz" both name a hamlet.
STREET_TYPES = {
    "via": "via", "v": "via", "viale": "viale", "vle": "viale", "vicolo": "vicolo", "vlo": "vicolo", "vic": "vicolo",
    "piazza": "piazza", "pza": "piazza", "pzza": "piazza", "pzz": "piazza", "piazzale": "piazzale", "ple": "piazzale",
    "largo": "largo", "lgo": "largo", "l": "largo", "corso": "corso", "cso": "corso",
    "strada": "strada", "sda": "strada", "str": "strada", "localita": "localita", "loc": "localita", "frazione": "localita", "fraz": "localita", "fr": "localita",
    "contrada": "contrada", "cda": "contrada", "borgo": "borgo",
}
# Words of a street name by their abbreviations.
WORDS = {"d": "della", "dlla": "della", "s": "san", "sta": "santa", "ss": "santi", "f": "fratelli", "flli": "fratelli", "gen": "generale", "dott": "dottor"}
AMBIGUOUS = ("v", "l")
_SOFT = {"della", "del", "dei", "degli", "delle", "di", "da", "dello", "dell", "san", "santa"}
_ROMAN = re.compile(r"(?i)^(?=[ivxlc]+$)(c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$")
_NUMERALS = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100}


def roman(word: str) -> int | None:
    """Value of a roman numeral; None where the word is none."""
    if not word or not _ROMAN.match(word):
        return None
    values = [_NUMERALS[c] for c in word.lower()]
    return sum(-a if a < b else a for a, b in zip(values, values[1:] + [0]))


# A care-of remark or a telephone number behind the address.
_REMARK = re.compile(r"(?i)\s*(?:[,;-]\s*)?(?:\(\s*(?:famiglia|fam\.?|tel|cell|c/o|presso|citofono|sig)\b.*|\bc/o\b.*|\bpresso\b.*|\bcitofono\b.*|\bfamiglia\b.*|\b(?:tel|cell|telefono|cellulare|mobile|fax)\b[.:]?\s*[+(\d].*|(?:\+39|0039)[\d\s./()-]{6,}.*)$")
_COUNTRY = re.compile(r"(?i)[,\s]*\bitalia\b[,\s]*")
_PROVINCE = re.compile(r"\(\s*[A-Za-z]{2}\s*\)")
_POSTCODE = re.compile(r"(?<!\d)\d{5}(?!\d)")
_NONE = re.compile(r"(?i)(?<![a-z])(?:s\s*\.?\s*n\s*\.?\s*c\b\.?|senza\s+numero(?:\s+civico)?)")
_MARK = r"(?:(?:civico|civ|numero|num|nr|no|n)\s*[.°º]?\s*[°º]?|[°º])\s*"
_SUFFIX = r"(?:\s*[/-]?\s*(bis|ter|quater)|\s*[/-]\s*([a-z])|\s?([a-z]))?(?![a-zà-ù0-9'.])"
_TRAILING = re.compile(rf"(?i)(?:[\s,]+|^)(?:{_MARK})?(\d{{1,4}}){_SUFFIX}\s*$")
_LEADING = re.compile(rf"(?i)^(?:{_MARK})?(\d{{1,4}}){_SUFFIX}\s*[,\s]\s*(?=\S)")
_MARKED = re.compile(rf"(?i)(?:^|[\s,])(?:{_MARK})(\d{{1,4}}){_SUFFIX}")


def plain(text: str) -> str:
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c))


def comune_name(text: str | None) -> str:
    """Words of a comune joined by hyphens; the empty string where there is none."""
    return "-".join(re.findall(r"[a-z0-9]+", plain(text or "").lower()))


def _street_words(part: str) -> tuple[str, tuple[str, ...]]:
    part = re.sub(r"(?i)\b([a-z])\.([a-z])\.\s?(?=[a-z])(?!\w\.)", r"\1\2. ", part) if re.match(r"(?i)^(?:[a-z]\.){2}", part) else part
    s = plain(part).lower().replace("°", " ")
    s = re.sub(r"\b(v|p|c|s|l)\.\s?(le|lo|za|zza|so|da|go)\b\.?", r"\1\2 ", s)
    words = re.findall(r"[a-z0-9]+", s)
    kind = ""
    # "V. Rossi" and "L. Rossi" may stand for via and largo or for a given name: left to the comparison.
    initial = len(words) == 2 and words[0] in AMBIGUOUS
    if len(words) > 1 and words[0] in STREET_TYPES and not initial:
        kind, words = STREET_TYPES[words[0]], words[1:]
    out = []
    for i, w in enumerate(words):
        value = roman(w) if i == 0 and i + 1 < len(words) and (len(w) > 1 or w in "ivx") else None
        if w.isdigit():
            out.append(str(int(w)))
        elif value is not None and not (len(w) == 1 and re.search(rf"\b{w}\.", s)):
            out.append(str(value))
        else:
            out.append(w)
    return kind, tuple(out)


class Gazetteer:
    """Known comuni and the comune of each postcode; bounded by the country, not by the listings."""

    def __init__(self, names: set[str], postcodes: dict[str, str]):
        self.names, self.postcodes = frozenset(names), postcodes

    def find(self, *texts: str | None) -> str:
        """The comune that one of the texts names, or the empty string."""
        for text in texts:
            words = comune_name(text).split("-")
            for length in range(min(6, len(words)), 0, -1):
                for start in range(len(words) - length, -1, -1):
                    name = "-".join(words[start : start + length])
                    if name in self.names:
                        return name
        return ""


def address_comune(raw: str | None, gazetteer: "Gazetteer") -> str:
    """The comune that an address names or that its postcode belongs to, or the empty string."""
    if not raw or not raw.strip():
        return ""
    found = split_address(raw, "", gazetteer)
    if found:
        return found[0]
    return gazetteer.postcodes.get(next(iter(_POSTCODE.findall(raw)), ""), "") or gazetteer.find(raw)


def split_address(raw: str, comune: str, gazetteer: "Gazetteer") -> tuple[str, str, str, str, tuple[str, ...]] | None:
    """(comune, number, suffix, street type, street words), number and comune empty where missing; None without a street.

    ``comune`` is the listing's own (may be empty: then the address names it).
    The gazetteer holds the comuni that may stand in addresses and their postcodes.
    """
    known, postcodes = gazetteer.names, gazetteer.postcodes
    s = re.sub(r"\s+", " ", raw).strip()
    s = _REMARK.sub("", s)
    s = _COUNTRY.sub(", ", s)
    s = _PROVINCE.sub(" ", s)
    unnumbered = bool(_NONE.search(s))
    s = _NONE.sub(" ", s)
    named = comune or postcodes.get(next(iter(_POSTCODE.findall(s)), ""), "")
    s = _POSTCODE.sub(",", s)
    flat = plain(s)
    # Comune names at the edges of the address or of one of its parts.
    parts = [p.strip(" .;") for p in re.split(r",|\s[-–]\s", flat)]
    kept: list[str] = []
    for p in parts:
        name = comune_name(p)
        tail = re.match(r"(?i)^(.*\S)\s+([a-z]{2})$", p)
        if name in known:
            named = named or name
        elif tail and comune_name(tail.group(1)) in known:  # "Fontecrina VT"
            named = named or comune_name(tail.group(1))
        elif not p or kept and re.fullmatch(r"(?i)[a-z]{2}", p):  # a province
            continue
        else:
            kept.append(p)
    if kept:
        words = kept[-1].split()
        end = len(words) - 1 if len(words) > 1 and re.fullmatch(r"[A-Z]{2}", words[-1]) else len(words)
        for start in range(max(1, end - 6), end):  # the longest comune that ends the street part
            name = comune_name(" ".join(words[start:end]))
            if name in known and not re.fullmatch(r"(?i)(?:loc\w*|fraz\w*|via|v)\W*", " ".join(words[:start])):
                kept[-1], named = " ".join(words[:start]).rstrip(" ,-"), named or name
                break
    s = ", ".join(k for k in kept if k)
    number = suffix = ""
    for rule in (_TRAILING, _MARKED, _LEADING):
        m = rule.search(s)
        if m and not unnumbered:
            rest = (s[: m.start()] + " " + s[m.end() :]).strip(" ,")
            if not re.search(r"[A-Za-z]{2}", rest):
                continue
            number, suffix = str(int(m.group(1))), next((g for g in m.groups()[1:] if g), "").lower()
            s = rest
            break
    kind, words = _street_words(s.strip(" ,.-"))
    if not any(len(w) > 1 and not w.isdigit() for w in words):
        return None
    return named, number, suffix, kind, words


def parse_address(raw: str, comune: str, gazetteer: "Gazetteer") -> tuple[str, str, str, str, tuple[str, ...]] | None:
    """``split_address`` where comune, number and street are all there, else None."""
    found = split_address(raw, comune, gazetteer)
    return found if found and found[0] and found[1] else None


def _osa(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions, ``most + 1`` where it is greater."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            new.append(cost)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


# Costs of the alignment. A pair is one street up to LIMIT.
GAP_OPEN, GAP_EXTEND, SOFT_GAP, SWAPPED, NO_TYPE, OTHER, LIMIT = 0.6, 0.3, 0.1, 0.1, 0.2, 3.0, 1.3


@lru_cache(maxsize=500_000)
def word_cost(a: str, b: str) -> float:
    if a == b:
        return 0.0
    if WORDS.get(a, a) == WORDS.get(b, b):
        return 0.05
    if a.isdigit() or b.isdigit():
        return OTHER
    short, long = sorted((a, b), key=len)
    if len(short) == 1:
        return 0.1 if long[0] == short else OTHER
    if len(short) < 5:
        return OTHER
    distance = _osa(a, b, 2 if len(short) >= 8 else 1)
    return {1: 0.4, 2: 0.8}.get(distance, OTHER) if distance <= (2 if len(short) >= 8 else 1) else OTHER


def _is_main(word: str) -> bool:
    return len(word) > 1 and WORDS.get(word, word) not in _SOFT


def _align(a: tuple[str, ...], b: tuple[str, ...]) -> float:
    """Affine-gap alignment of two word sequences (Gotoh).

    Only the address with more main words may leave main words out: two different
    names never pass as two omissions.
    """
    inf = float("inf")
    more = sum(map(_is_main, a)) - sum(map(_is_main, b))
    gap = lambda word, allowed, opening: SOFT_GAP if not _is_main(word) else (opening if allowed else OTHER)
    n, m = len(a), len(b)
    match = [[inf] * (m + 1) for _ in range(n + 1)]
    left, up = [[inf] * (m + 1) for _ in range(n + 1)], [[inf] * (m + 1) for _ in range(n + 1)]
    match[0][0] = 0.0
    for i in range(n + 1):
        for j in range(m + 1):
            if i and j:
                match[i][j] = min(match[i - 1][j - 1], left[i - 1][j - 1], up[i - 1][j - 1]) + word_cost(a[i - 1], b[j - 1])
            if i:
                w, ok = a[i - 1], more > 0
                up[i][j] = min(min(match[i - 1][j], left[i - 1][j]) + gap(w, ok, GAP_OPEN), up[i - 1][j] + gap(w, ok, GAP_EXTEND))
            if j:
                w, ok = b[j - 1], more < 0
                left[i][j] = min(min(match[i][j - 1], up[i][j - 1]) + gap(w, ok, GAP_OPEN), left[i][j - 1] + gap(w, ok, GAP_EXTEND))
    return min(match[n][m], left[n][m], up[n][m])


def _readings(kind: str, words: tuple[str, ...]) -> list[tuple[str, tuple[str, ...]]]:
    if not kind and len(words) == 2 and words[0] in AMBIGUOUS:
        return [("", words), (STREET_TYPES[words[0]], words[1:])]
    return [(kind, words)]


def street_cost(kind_a: str, a: tuple[str, ...], kind_b: str, b: tuple[str, ...]) -> float:
    """What it costs to read two streets as one; given and family name may have changed places."""
    best = OTHER
    for ka, x in _readings(kind_a, a):
        for kb, y in _readings(kind_b, b):
            if ka and kb and ka != kb:
                continue
            cost = min([_align(x, y)] + ([SWAPPED + _align(x[1:] + x[:1], y)] if len(x) > 1 else []))
            if any(word_cost(v, w) < 1 and len(v) > 1 for v in x for w in y if not v.isdigit()):
                best = min(best, cost + (NO_TYPE if ka != kb else 0.0))
    return best


BANDS, ROWS = 30, 3
_ALPHABET = {c: i for i, c in enumerate("#abcdefghijklmnopqrstuvwxyz0123456789")}


@lru_cache(maxsize=1)
def _permutations() -> np.ndarray:
    """Hash values of all two-letter grams for each MinHash function."""
    rng = np.random.default_rng(20_240_601)
    return rng.integers(0, 2**32, size=(len(_ALPHABET) ** 2, BANDS * ROWS), dtype=np.uint64)


def minhash_bands(word: str) -> list[int]:
    codes = [_ALPHABET[c] for c in f"#{word}#"]
    grams = list({x * len(_ALPHABET) + y for x, y in zip(codes, codes[1:])})
    values = _permutations()[grams].min(axis=0).reshape(BANDS, ROWS)
    mixed = (values[:, 0] * np.uint64(0x9E3779B97F4A7C15)) ^ (values[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (values[:, 2] << np.uint64(29))
    return [int(x) for x in (mixed + np.arange(BANDS, dtype=np.uint64)).view(np.int64)]


def known_places(listings: DataFrame) -> Gazetteer:
    """The comuni of the listings, and for each postcode of their addresses the comune that it stands with most often.

    Spellings are brought to one form before they are counted; what is left is bounded by the country's comuni.
    """

    @F.pandas_udf("string")
    def one_name(texts: pd.Series) -> pd.Series:
        return texts.map(comune_name)

    code = F.regexp_extract(F.coalesce("address_raw", F.lit("")), r"(?<!\d)\d{5}(?!\d)", 0)
    spelt = listings.where(F.col("comune").isNotNull()).groupBy(F.col("comune").alias("spelling"), code.alias("code")).count()
    spelt = cut_lineage(spelt.withColumn("comune", one_name("spelling")).where(F.col("comune") != "").groupBy("comune", "code").agg(F.sum("count").alias("n")))
    names = spelt.select("comune").distinct()
    if not small_enough(names):
        raise ValueError("more different comuni than a country can have")
    codes = spelt.where(F.col("code") != "").groupBy("code").agg(F.max_by("comune", F.struct("n", "comune")).alias("comune"))
    # There are at most 100,000 codes of five digits.
    return Gazetteer({r.comune for r in names.collect()}, {r.code: r.comune for r in codes.collect()})


def parse_addresses(listings: DataFrame) -> DataFrame:
    """``rec, place``: the parsed address of every listing that has a street and a house number.

    ``listings`` needs rec, comune, address_raw and, to find a missing comune, zona_raw, title and caption.
    """
    gazetteer = listings.sparkSession.sparkContext.broadcast(known_places(listings))

    @F.pandas_udf("struct<comune:string,number:string,suffix:string,kind:string,words:array<string>>")
    def parse(raw: pd.Series, comune: pd.Series, zone: pd.Series, title: pd.Series, caption: pd.Series) -> pd.DataFrame:
        known = gazetteer.value
        rows = []
        for text, own, *others in zip(raw, comune, zone, title, caption):
            name = comune_name(own) or known.find(*others)
            rows.append(parse_address(text, name, known) or (None,) * 5)
        return pd.DataFrame(rows, columns=["comune", "number", "suffix", "kind", "words"])

    parsed = listings.where(F.trim("address_raw") != "").select("rec", parse("address_raw", "comune", "zona_raw", "title", "caption").alias("place"))
    return parsed.where(F.col("place.number").isNotNull())


def same_address_pairs(listings: DataFrame) -> DataFrame:
    """``rec_a, rec_b`` (rec_a < rec_b): different listings at the same street, number, suffix and comune.

    Addresses that are NULL, empty, too coarse or without a house number are in no
    pair, as are rows without a comune that nothing names. Equal addresses are
    collapsed before anything is compared, and words are compared once for each
    comune, not once for each address; a place with many listings costs only the
    pairs that the result holds.
    """
    columns = ["rec", "comune", "address_raw", "zona_raw", "title", "caption"]
    parsed = cut_lineage(parse_addresses(cut_lineage(listings.select(*columns))).distinct().withColumn("digest", F.md5(F.to_json("place"))))
    key = ["comune", "number", "suffix"]
    # Numbered once and written: the ids stay as they are, and rows of candidates are short.
    places = cut_lineage(parsed.select("digest", "place.*").dropDuplicates(["digest"]).select(F.monotonically_increasing_id().alias("pid"), "*"))
    # Words that tell streets apart; all words of a street that has none of these.
    telling = F.filter("words", lambda w: (F.length(w) > 1) & ~w.isin(*_SOFT))
    words = places.select("pid", *key, F.explode(F.array_distinct(F.when(F.size(telling) > 0, telling).otherwise(F.col("words")))).alias("word"))

    @F.pandas_udf("array<long>")
    def bands(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([minhash_bands(w) for w in batch], dtype=object)

    vocabulary = words.select("comune", "word").distinct()
    # Words of fewer than five letters are never compared by their letters: they are near to themselves only.
    hashed = cut_lineage(vocabulary.where(F.length("word") > 4).select("comune", "word", bands("word").alias("bands")))
    banded = hashed.select("comune", "word", F.explode("bands").alias("band"))
    near = (
        banded.join(banded.select("comune", "band", F.col("word").alias("other")), ["comune", "band"])
        .where((F.col("word") < F.col("other")) & (F.abs(F.length("word") - F.length("other")) <= 2) & (F.levenshtein("word", "other", 4) >= 0))
        .select("comune", "word", "other").distinct()
    )
    near = cut_lineage(near)
    neighbours = near.unionByName(near.select("comune", F.col("other").alias("word"), F.col("word").alias("other"))).unionByName(vocabulary.withColumn("other", F.col("word")))
    # Place and word meet as one hash; the places themselves are compared afterwards.
    meeting = F.xxhash64(*key, "word").alias("meeting")
    reach = words.join(neighbours, ["comune", "word"]).select(F.col("pid").alias("p1"), *key, F.col("other").alias("word")).select("p1", meeting)
    pairs = cut_lineage(reach.join(words.select(F.col("pid").alias("p2"), meeting), "meeting").where(F.col("p1") < F.col("p2")).select("p1", "p2").distinct())

    @F.pandas_udf("double")
    def cost(kind_a: pd.Series, a: pd.Series, kind_b: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([street_cost(ka, tuple(x), kb, tuple(y)) for ka, x, kb, y in zip(kind_a, a, kind_b, b)], dtype="float64")

    side = lambda n: places.select(F.col("pid").alias(f"p{n}"), F.struct(*key).alias(f"at{n}"), F.col("kind").alias(f"kind{n}"), F.col("words").alias(f"words{n}"))
    same = pairs.join(side(1), "p1").join(side(2), "p2").where("at1 = at2").where(cost("kind1", "words1", "kind2", "words2") <= LIMIT).select("p1", "p2")
    same = cut_lineage(same.unionByName(places.select(F.col("pid").alias("p1"), F.col("pid").alias("p2"))))
    members = parsed.select("rec", "digest").join(places.select("digest", "pid"), "digest").select("rec", "pid")
    left = members.select(F.col("pid").alias("p1"), F.col("rec").alias("r1"))
    right = members.select(F.col("pid").alias("p2"), F.col("rec").alias("r2"))
    return (
        same.join(left, "p1").join(right, "p2").where(F.col("r1") != F.col("r2"))
        .select(F.least("r1", "r2").alias("rec_a"), F.greatest("r1", "r2").alias("rec_b")).distinct()
    )
