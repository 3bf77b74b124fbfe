"""Personal information in free text: a skip-chain conditional random field.

Tokens carry labels (outside, or begin/inside of e-mail, phone, identity number,
person, address). The field has token potentials from words, shapes, context and
loose lexer hits, chain potentials between neighbours, and skip potentials between
tokens of a document that are equal or alike, wherever they stand. Loopy message
passing alternates between the chains and the skip edges; a message over an edge
leaves out what came over that edge.

All potentials are learned by maximum likelihood on a bounded sample. Its labels are
partial: a hit of a lexer is a piece where its form or its context leaves no doubt
("P.IVA ...", "Chiedere di ...", a tax code), is none where these speak against it,
and is left open otherwise; open hits are summed over, so they teach nothing wrong.
Sentences without any hit hold no piece and are not labelled. What the field labels
is bounded by the lexer hit that it covers.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagliaio.llm.addresses import Gazetteer, comune_name, split_address
from pagliaio.session import cut_lineage
from pagliaio.tables import small_enough

KINDS = ["email", "phone", "id_number", "person", "address"]
PLACEHOLDERS = {k: f"[{k.upper()}]" for k in KINDS}
LABELS = 1 + 2 * len(KINDS)  # 0 outside; 2k+1 begin, 2k+2 inside of kind k

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_TYPE = r"(?:via|viale|v\.?\s?le|v\.|vicolo|vic\.|v\.?\s?lo|piazza|p\.?\s?zz?a|piazzale|largo|l\.?\s?go|corso|c\.?\s?so|strada|s\.?\s?da|str\.|localit[aà]['’]?|loc\.?|frazione|fraz\.?|contrada)"
_NUMBER = r"(?:(?:n(?:r|um)?|civ|civico|numero)\b\.?\s*[°º]?|n\s?[°º]|[°º])?\s*\d{1,4}(?:\s?[/-]?\s?(?:bis|ter|quater)|\s?[/-]\s?[A-Za-z]|\s?[A-Za-z])?(?![\w'’])"
_WORD = rf"(?:(?<![{_LETTER}])[{_LETTER}]\.|[{_LETTER}][{_LETTER}'’]*)"
# Loose lexers: everything that may be a piece of a kind.
LEXERS = {
    "email": re.compile(rf"(?i)[a-z0-9][\w.+-]*\s?(?:@|\[at\]|\(at\)|\{{at\}}|\[@\]|\bchiocciola\b|\bat\b)\s?[a-z0-9-]+(?:(?:\.|\s?\[dot\]\s?|\s?\(dot\)\s?|\s+punto\s+|\s+dot\s+)[a-z0-9-]+)+"),
    "phone": re.compile(
        r"(?i)(?<![\w/.,-])(?:(?:\+|00)39[\s./-]?)?(?:\(\d{2,4}\)|\d{2,4})(?:[\s./-]*\d){5,9}(?![\w/-])"
        r"|(?<![\w/.,-])(?:(?:\+|00)39\s?)?\d{2,4}(?:\s(?:zero|uno|due|tre|quattro|cinque|sei|sette|otto|nove)){4,9}\b"
    ),
    "id_number": re.compile(
        r"(?i)(?<!\w)[a-z]{6}\s?\d{2}\s?[a-z]\s?\d{2}\s?[a-z]\s?\d{3}\s?[a-z](?!\w)|(?<!\w)it\d{2}(?:\s?[a-z0-9]){23}(?!\w)|(?<!\w)(?:it\s?)?\d{11}(?!\w)|(?<!\w)[a-z]{2}\s?\d{5,7}\s?[a-z]{0,2}(?!\w)"
    ),
    "person": re.compile(rf"(?<![\w'’])(?:[A-ZÀ-Ö]\.\s?(?:[A-ZÀ-Ö]\.\s?)?|[A-ZÀ-Ö][{_LETTER}'’]+\s+)[A-ZÀ-Ö][{_LETTER}'’]+(?![\w’])"),
    "address": re.compile(rf"(?i)(?<![\w.'’])(?:{_TYPE}\s*(?:\d{{1,2}}\s+(?=[A-Z]))?(?:{_WORD}\s*){{1,4}}?,?\s*{_NUMBER}|{_NUMBER}\s*,?\s+{_TYPE}\s+{_WORD}(?:\s+{_WORD})?)"),
}
# General forms that announce a piece of a kind, and that announce another number.
_BEFORE = {
    "phone": re.compile(r"(?i)(?:\btel(?:efon\w*)?|\bcell(?:ulare)?|\bchiamare(?: il| lo)?|\bchiamate(?: il)?|\bnumero|\bwapp|\bwhatsapp|\bmobile|\bfax)\b[\s.:]*$"),
    "id_number": re.compile(r"(?i)(?:\bp\.?\s?iva|\bpartita iva|\bc\.?f\.?:?|\bcod(?:ice|\.) fisc(?:ale|\.)|\biban|\bconto|\bdocumento(?: n\.)?|\bc\.i\.|\bcarta d['’]identit[aà](?: n\.)?|\bpassaporto(?: n\.)?|\bpatente(?: n\.)?)[\s:]*$"),
    "person": re.compile(r"(?i)(?:\bsig(?:\.ra|\.na|\.|nor|nora)?|\bdott(?:\.ssa|\.|\.r)?|\bgeom\.|\barch\.|\bavv\.|\bing\.|\brag\.|\bchiedere di|\breferente:?|\bintestato a|\beredi di|\bc/o|\bpresso|\bfamiglia|\bcitofono)\s*$"),
}
_OTHER_NUMBER = re.compile(r"(?i)(?:\bannunci\w*|\brif(?:\.|eriment\w*)|\bpratica|\bcod\.|\bcodice|\bprot(?:\.|ocollo)|\bfoglio|\bparticell\w*|\bmappale|\bsub(?:\.|altern\w*)|\bfascicolo|\bscheda|€|\beuro)\W*(?:(?:n|nr|num)\b\W*|numero\s*)?$")
_COMPANY = re.compile(r"(?i)^(?:immobiliare|immobil\w*|agenzia|studio|casa|case|gruppo|societ[aà]|impresa|ditta|consorzio|banca)\b")
_ADDRESS_BEFORE = re.compile(r"(?i)(?:\b(?:in|da|presso)|\bè in|\brisiede in)\s+$")
# Forms that are an identity number or a telephone number by themselves.
_FORM = {
    "id_number": re.compile(r"(?i)[a-z]{6}\s?\d{2}\s?[a-z]\s?\d{2}\s?[a-z]\s?\d{3}\s?[a-z]$|it\d{2}(?:\s?[a-z0-9]){23}$"),
    "phone": re.compile(r"(?:\+|00)39"),
}
# Forms of dates, which are no telephone numbers.
_DATE = re.compile(r"\d{1,2}([./-])\d{1,2}\1(?:19|20)?\d{2}$|(?:19|20)\d{2}([./-])\d{1,2}\2\d{1,2}$")

TOKEN = re.compile(rf"[{_LETTER}]+|\d+|[^\w\s]|_|[^\W\d_]+")


_STREET_FIRST = re.compile(r"(?i)(?:via|viale|vicolo|piazza|piazzale|largo|corso|strada|localit[aà]|loc|frazione|contrada)\b")
_STREET_BEFORE = re.compile(rf"(?i)(?<![{_LETTER}]){_TYPE}\s*$")


def lex(text: str, field: str, known: Gazetteer) -> list[tuple[int, int, str]]:
    """All lexer hits. A name behind a street type, or with one, is the street's.

    A field that holds one address is parsed as such: a name in it belongs to the street unless it is announced.
    """
    found = [(m.start(), m.end(), kind) for kind in KINDS for m in LEXERS[kind].finditer(text)]
    person = lambda s: not _STREET_FIRST.match(text, s) and not _STREET_BEFORE.search(text[max(0, s - 12) : s]) and (field != "address_raw" or _BEFORE["person"].search(text[max(0, s - 40) : s]))
    found = [(s, e, kind) for s, e, kind in found if kind != "person" or person(s)]
    whole = address_field(text, known) if field == "address_raw" and text else None
    if whole:
        found = [f for f in found if f[2] != "address" and not (f[2] == "person" and f[0] < whole[1] and whole[0] < f[1])] + [(*whole, "address")]
    return found


def _edges(raw: str, known: Gazetteer) -> int:
    """Where the street or number of a postal address starts: behind postcode and comune."""
    at = len(raw) - len(raw.lstrip())
    while True:
        m = re.match(r"\s*(?:\d{5}\s+)?([^,\d]+?)\s*(?:,|\s[-–])\s*(?=\S)", raw[at:])
        if not m or comune_name(m.group(1)) not in known.names:
            m = re.match(r"\s*\d{5}\s*,?\s+(?=\D)", raw[at:])
            if not m:
                return at
        at += m.end()


def address_field(raw: str, known: Gazetteer) -> tuple[int, int] | None:
    """Span of the street with its house number in a field that holds one address."""
    found = split_address(raw, "-", known)
    if not found or not found[1]:
        return None
    start = _edges(raw, known)
    first_word = max((raw.lower().find(w) for w in found[4] if len(w) > 3), default=start)
    numbers = [m.end() for m in re.finditer(r"\d{1,4}(?:\s?[/-]?\s?(?:bis|ter|quater|[A-Za-z]))?(?![\w'’])", raw[start:])]
    return start, start + (numbers[0] if numbers else len(raw) - start) if first_word < 0 else max(start + (numbers[0] if numbers else 0), first_word + 3)


YES, NO, OPEN = 1, 0, -1


def judge(text: str, field: str, hits: list[tuple[int, int, str]], known: Gazetteer, ordinary: frozenset[str] = frozenset(), companies: frozenset[str] = frozenset(), names: frozenset[str] = frozenset()) -> list[tuple[int, int, str, int]]:
    """Every hit with what its form and context say about it: a piece, none, or nothing that is certain.

    ``ordinary``: words that texts also write in lower case; ``companies``: names of agencies in lower case;
    ``names``: words of persons that are known from elsewhere.
    """
    out = []
    places = [(s, e) for s, e, k in hits if k == "address"]
    for start, end, kind in hits:
        before, piece = text[:start][-40:], text[start:end]
        if kind == "email":
            verdict = YES
        elif kind == "address":
            verdict = YES if field == "address_raw" or _ADDRESS_BEFORE.search(before) else OPEN
        elif _BEFORE[kind].search(before):
            verdict = NO if kind == "person" and _COMPANY.match(piece) else YES
        elif kind == "person":
            words = [w.lower() for w in re.findall(rf"[{_LETTER}]+", piece) if len(w) > 1]
            none = _COMPANY.match(piece) or any(w in ordinary for w in words) or any(s < end and start < e for s, e in places) or " ".join(words) in companies or comune_name(piece) in known.names
            verdict = NO if none or re.search(rf"(?i)\b{_TYPE}\s*$", before) else YES if any(w in names for w in words) else OPEN
        elif _OTHER_NUMBER.search(before) or _DATE.match(piece):
            verdict = NO
        else:
            verdict = YES if _FORM[kind].match(piece) else OPEN
        out.append((start, end, kind, verdict))
    return out


def sure_pieces(text: str, field: str, known: Gazetteer) -> list[tuple[int, int, str]]:
    """Hits that are pieces beyond doubt, the first kind where two overlap."""
    out: list[tuple[int, int, str]] = []
    for start, end, kind, verdict in sorted(judge(text, field, lex(text, field, known), known), key=lambda x: x[2] != "address"):
        if verdict == YES and not any(s < end and start < e for s, e, _ in out):
            out.append((start, end, kind))
    return out


BUCKETS = 1 << 15


def _h(text: str) -> int:
    return zlib.crc32(text.encode()) % (BUCKETS - 1) + 1  # 0 is padding


_word_memo: dict[str, tuple[int, int, int, int, int, int]] = {}


def _word_features(word: str) -> tuple[int, int, int, int, int, int]:
    known = _word_memo.get(word)
    if known is None:
        low = word.lower()
        shape = re.sub(r"[A-ZÀ-Ö]+", "X", re.sub(r"[a-zà-ÿ]+", "x", word)) if not word.isdigit() else f"9{min(len(word), 12)}"
        known = (_h("w=" + low), _h("s=" + shape), _h("e=" + low[-3:] + shape[:1]), _h("p=" + low), _h("n=" + low), _h("q=" + low))
        if len(_word_memo) < 200_000:
            _word_memo[word] = known
    return known


_FEATURES = 13


def featurize(tokens: list[re.Match], hits: list[tuple[int, int, str]], field: str, ranges: list[tuple[int, int]]) -> list[np.ndarray]:
    """Feature numbers [length, _FEATURES] of each token range."""
    tags = [["-"] * len(tokens) for _ in KINDS]
    starts = [t.start() for t in tokens]
    for s, e, kind in hits:
        row = tags[KINDS.index(kind)]
        i = bisect_left(starts, s)
        first = True
        while i < len(tokens) and starts[i] < e:
            row[i] = "B" if first else "I"
            first = False
            i += 1
    none = _word_features("")
    word = lambda i: _word_features(tokens[i].group()) if 0 <= i < len(tokens) else none
    out = []
    for a, b in ranges:
        words = [word(i) for i in range(a - 2, b + 2)]
        tag = ["".join(r[i] for r in tags) if i >= 0 else "^" for i in range(a - 1, b)]
        rows = np.zeros((b - a, _FEATURES), dtype=np.int32)
        for i in range(b - a):
            p2, p1, (w, s, e, *_), n1, n2 = words[i : i + 5]
            t = tag[i + 1]
            rows[i] = (w, s, e, p1[3], p2[5], n1[4], (p1[3] * 31 + p2[5]) % (BUCKETS - 1) + 1, _h("t=" + t), _h("tb=" + t + tag[i]), _h("tf=" + t + field), _h(f"tp={t}{p1[0]}"), _h(f"tpp={t}{p2[0]}"), _h(f"tn={t}{n1[0]}{n2[1]}"))
        out.append(rows)
    return out


#: Tokens from which on a sentence is cut where no hit goes on.
LONG_SENTENCE = 48


def sentences(tokens: list[re.Match], hits: list[tuple[int, int, str]], text: str) -> list[tuple[int, int]]:
    """Token ranges of the sentences that hold a hit; no cut falls inside a hit."""
    starts = [t.start() for t in tokens]
    joined, touched = np.zeros(len(tokens) + 1, dtype=bool), np.zeros(len(tokens) + 1, dtype=bool)
    for s, e, _ in hits:
        i, j = bisect_left(starts, s), bisect_left(starts, e)
        touched[i:j] = True
        joined[i : max(i, j - 1)] = True
    out, last = [], 0
    for i, t in enumerate(tokens):
        if joined[i]:
            continue
        final = i + 1 == len(tokens)
        stop = final or t.group() in ".!?" and text[t.end() : t.end() + 1].isspace() and tokens[i + 1].group()[:1].isupper() and len(tokens[i - 1].group() if i else "") > 2
        if stop or i - last + 1 >= LONG_SENTENCE or "\n" in text[t.end() : tokens[i + 1].start()]:
            if touched[last : i + 1].any():
                out.append((last, i + 1))
            last = i + 1
    return out


class Document:
    """Tokens, hits and labelled sentences of the texts of one record, and the skip edges between their tokens."""

    def __init__(self, texts: list[tuple[str, str]], known: Gazetteer):
        self.texts, self.tokens, self.hits, self.places, self.rows = texts, [], [], [], []
        for k, (text, field) in enumerate(texts):
            hits = lex(text, field, known) if text else []
            tokens = list(TOKEN.finditer(text)) if hits else []
            ranges = sentences(tokens, hits, text) if hits else []
            self.tokens.append(tokens)
            self.hits.append(hits)
            self.places += [(k, a, b) for a, b in ranges]
            self.rows += featurize(tokens, hits, field, ranges)
        self.edges = self._edges()

    def _edges(self) -> list[tuple[tuple[int, int], tuple[int, int], int]]:
        """(token, token, 0 equal or 1 alike); a token is (sentence, place). Each occurrence is tied to the next one."""
        seen: dict[tuple, tuple[int, int]] = {}
        edges = []

        def tie(key: tuple, at: tuple[int, int], kind: int) -> None:
            if key in seen and seen[key] != at:
                edges.append((seen[key], at, kind))
            seen[key] = at

        spelt: dict[str, set[str]] = {}
        for n, (k, a, b) in enumerate(self.places):
            starts = [t.start() for t in self.tokens[k][a:b]]
            inside = set()
            for s, e, kind in self.hits[k]:
                i, j = bisect_left(starts, s), bisect_left(starts, e)
                inside.update(range(i, j))
                if kind in ("phone", "id_number") and i < j:  # one number, grouped in another way
                    tie(("number", re.sub(r"^(?:\+|00)39", "", re.sub(r"[\s./()-]", "", self.texts[k][0][s:e].lower()))), (n, i), 1)
            for i in sorted(inside):
                word = self.tokens[k][a + i].group().lower()
                if len(word) > 2:
                    tie(("word", word), (n, i), 0)
                    if len(word) > 4 and word.isalpha() and word not in spelt:
                        spelt[word] = {word[:x] + word[x + 1 :] for x in range(len(word))} | {word}
        by_form: dict[str, str] = {}
        pairs = set()
        for word, forms in spelt.items():
            for form in forms:
                other = by_form.setdefault(form, word)
                if other != word:
                    pairs.add((other, word))
        return edges + [(seen["word", x], seen["word", y], 1) for x, y in sorted(pairs) if seen["word", x] != seen["word", y]]


def _label_sets(doc: Document, n: int, verdicts: list[tuple[int, int, str, int]]) -> np.ndarray:
    """[length, LABELS] of 0 and a large negative number: the labels that sentence ``n`` may have."""
    k, a, b = doc.places[n]
    starts = [t.start() for t in doc.tokens[k][a:b]]
    may = np.full((b - a, LABELS), -30.0)
    may[:, 0] = 0.0
    taken = np.zeros(b - a, dtype=bool)
    for want in (YES, OPEN):
        for s, e, kind, verdict in verdicts:
            i, j = bisect_left(starts, s), bisect_left(starts, e)
            if verdict != want or i >= j or taken[i:j].any():
                continue
            label = 1 + 2 * KINDS.index(kind)
            if want == YES:
                may[i:j] = -30.0
                taken[i:j] = True
            may[i, label] = 0.0
            may[i + 1 : j, label + 1] = 0.0
    return may


#: The sample that trains the field: at most so many texts, a third descriptions and the
#: rest the much shorter addresses, picked by hash.
TRAINING_TEXTS = 7500
#: Rounds of message passing between skip edges and chains.
SKIP_ROUNDS = 2
_COARSE = np.zeros((LABELS, 1 + len(KINDS)))
_COARSE[0, 0] = 1.0
for _k in range(len(KINDS)):
    _COARSE[1 + 2 * _k : 3 + 2 * _k, 1 + _k] = 1.0


def _allowed() -> np.ndarray:
    """0 where a label may follow another, a large negative number where not (inside only behind its own kind)."""
    t = np.zeros((LABELS, LABELS))
    for b in range(LABELS):
        if b and b % 2 == 0:
            t[:, b] = -30.0
            t[b - 1, b] = t[b, b] = 0.0
    return t


def _forward_backward(u: np.ndarray, mask: np.ndarray, trans: np.ndarray, pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of [n, T, L] unaries and, for training, the expected transitions."""
    n, steps, _ = u.shape
    et = np.exp(trans)
    start = np.ones(LABELS)
    start[2::2] = 1e-13
    a, b = np.zeros_like(u), np.ones_like(u)
    eu = np.exp(u - u.max(axis=2, keepdims=True))
    x = eu[:, 0] * start
    a[:, 0] = x / x.sum(axis=1, keepdims=True)
    for t in range(1, steps):
        x = (a[:, t - 1] @ et) * eu[:, t]
        a[:, t] = np.where(mask[:, t, None], x / np.maximum(x.sum(axis=1, keepdims=True), 1e-300), a[:, t - 1])
    expected = np.zeros((LABELS, LABELS))
    for t in range(steps - 2, -1, -1):
        y = eu[:, t + 1] * b[:, t + 1]
        x = y @ et.T
        x /= np.maximum(x.sum(axis=1, keepdims=True), 1e-300)
        b[:, t] = np.where(mask[:, t + 1, None], x, 1.0)
        w = mask[:, t + 1]
        if pairs and w.any():
            z = np.maximum(((a[w, t] @ et) * y[w]).sum(axis=1), 1e-300)
            expected += et * ((a[w, t] / z[:, None]).T @ y[w])
    m = a * b
    return m / np.maximum(m.sum(axis=2, keepdims=True), 1e-300), expected


def _pad(group: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(len(s[0]) for s in group)
    x = np.zeros((len(group), steps, _FEATURES), dtype=np.int32)
    may = np.zeros((len(group), steps, LABELS))
    mask = np.zeros((len(group), steps), dtype=bool)
    for i, (rows, sets) in enumerate(group):
        x[i, : len(rows)], mask[i, : len(rows)], may[i, : len(rows)] = rows, True, sets
    return x, may, mask


class Field:
    """Token weights [BUCKETS, LABELS], transitions and skip weights [equal or alike, outside and kinds]."""

    def __init__(self):
        self.w, self.trans = np.zeros((BUCKETS, LABELS), dtype=np.float32), _allowed()
        self.skip = np.zeros((2, 1 + len(KINDS)))

    def fit_chains(self, segments: list[tuple[np.ndarray, np.ndarray]], epochs: int = 5, batch: int = 256, rate: float = 0.25) -> None:
        """AdaGrad on the likelihood of the label sets: what they allow against everything."""
        rng = np.random.default_rng(11)
        g2 = np.full((BUCKETS, LABELS), 1e-6, dtype=np.float32)
        free, t2, allowed = np.zeros((LABELS, LABELS)), np.full((LABELS, LABELS), 1e-6), _allowed()
        for _ in range(epochs):
            order = rng.permutation(len(segments))
            for k in range(0, len(order), batch):
                part = sorted((segments[i] for i in order[k : k + batch]), key=lambda s: len(s[0]))
                for group in (part[: len(part) // 2], part[len(part) // 2 :]):
                    if not group:
                        continue
                    x, may, mask = _pad(group)
                    u = self.w[x].sum(axis=2, dtype=np.float64)
                    p, expected = _forward_backward(u, mask, free + allowed, True)
                    gold, seen = _forward_backward(u + may, mask, free + allowed, True)
                    diff = (gold - p)[mask]
                    ids = x[mask].ravel()
                    by = np.argsort(ids, kind="stable")
                    heads = np.flatnonzero(np.r_[True, ids[by][1:] != ids[by][:-1]])
                    sums = np.add.reduceat(np.repeat(diff, _FEATURES, axis=0)[by], heads, axis=0)
                    rows = ids[by][heads]
                    g2[rows] += sums**2
                    self.w[rows] += (rate * sums / np.sqrt(g2[rows])).astype(np.float32)
                    self.w[0] = 0.0
                    gt = seen - expected
                    t2 += gt**2
                    free += rate * gt / np.sqrt(t2)
            self.w *= 0.999
        self.trans = free + allowed

    def beliefs(self, docs: list[Document], may: list[np.ndarray] | None = None, rounds: int = SKIP_ROUNDS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
        """Marginals of all sentences of ``docs``, and both cavity beliefs (kinds) and the type of every skip edge.

        ``may`` restricts the labels of the sentences, in the order of the documents.
        """
        base = [d.places and len(d.places) or 0 for d in docs]
        offsets = np.concatenate([[0], np.cumsum(base)]).astype(int)
        rows = [r for d in docs for r in d.rows]
        first = [self.w[r].sum(axis=1, dtype=np.float64) for r in rows]
        if may is not None:
            first = [u + m for u, m in zip(first, may)]
        unary, belief = list(first), [None] * len(rows)

        def chains(which: list[int]) -> None:
            which = sorted(which, key=lambda i: len(unary[i]))
            for k in range(0, len(which), 512):
                part = which[k : k + 512]
                steps = max(len(unary[i]) for i in part)
                u, mask = np.zeros((len(part), steps, LABELS)), np.zeros((len(part), steps), dtype=bool)
                for j, i in enumerate(part):
                    u[j, : len(unary[i])], mask[j, : len(unary[i])] = unary[i], True
                p, _ = _forward_backward(u, mask, self.trans)
                for j, i in enumerate(part):
                    belief[i] = p[j, : len(unary[i])]

        chains(list(range(len(rows))))
        edges = [(offsets[d] + a[0], a[1], offsets[d] + b[0], b[1], t) for d, doc in enumerate(docs) for a, b, t in doc.edges]
        types = np.array([e[4] for e in edges], dtype=int)
        to_a, to_b = np.zeros((len(edges), LABELS)), np.zeros((len(edges), LABELS))
        strength = np.exp(self.skip)[types] - 1 if edges else np.zeros((0, 1 + len(KINDS)))

        def cavities() -> tuple[np.ndarray, np.ndarray]:
            out = []
            for message, s, t in ((to_a, 0, 1), (to_b, 2, 3)):
                logs = np.log(np.array([belief[e[s]][e[t]] for e in edges]).reshape(-1, LABELS) + 1e-12) - message
                p = np.exp(logs - logs.max(axis=1, keepdims=True))
                out.append(p / p.sum(axis=1, keepdims=True) @ _COARSE)
            return out[0], out[1]

        for _ in range(rounds if edges and self.skip.any() else 0):
            of_a, of_b = cavities()
            to_b, to_a = np.log1p(of_a * strength) @ _COARSE.T, np.log1p(of_b * strength) @ _COARSE.T
            changed = {}
            for e, ma, mb in zip(edges, to_a, to_b):
                for i, t, m in ((e[0], e[1], ma), (e[2], e[3], mb)):
                    if i not in changed:
                        changed[i] = first[i].copy()
                    changed[i][t] += m
            for i, u in changed.items():
                unary[i] = u
            chains(list(changed))
        of_a, of_b = cavities() if edges else (strength, strength)
        return belief, of_a, of_b, types

    def fit_skips(self, docs: list[Document], may: list[list[np.ndarray]], steps: int = 12, rate: float = 0.5) -> None:
        """Gradient steps on the skip weights: how often both ends are of one kind under the label sets, against freely."""
        tied = [k for k, d in enumerate(docs) if d.edges]
        docs, sets = [docs[k] for k in tied], [m for k in tied for m in may[k]]
        if not docs:
            return
        g2 = np.full_like(self.skip, 1e-6)
        for _ in range(steps):
            grad = -0.05 * self.skip
            for sign, allowed in ((1, sets), (-1, None)):
                _, a, b, types = self.beliefs(docs, allowed, rounds=1)
                both = a * b * np.exp(self.skip)[types]
                both /= (1 + (a * b * (np.exp(self.skip)[types] - 1)).sum(axis=1))[:, None]
                np.add.at(grad, types, sign * both)
            g2 += grad**2
            self.skip = np.clip(self.skip + rate * grad / np.sqrt(g2), -3.0, 3.0)

    def spans(self, docs: list[Document]) -> list[list[list[tuple[int, int, str]]]]:
        """Labelled spans of each text of each document."""
        out = [[[] for _ in d.texts] for d in docs]
        belief, *_ = self.beliefs(docs)
        for (d, (k, a, _)), p in zip(((d, place) for d, doc in enumerate(docs) for place in doc.places), belief):
            start = None
            for t, label in enumerate([*p.argmax(axis=1), 0]):
                if start is not None and (label == 0 or label % 2 == 1 or (label - 1) // 2 != start[1]):
                    tokens = docs[d].tokens[k]
                    out[d][k].append((tokens[a + start[0]].start(), tokens[a + t - 1].end(), KINDS[start[1]]))
                    start = None
                if label and start is None:
                    start = (t, (label - 1) // 2)
        return out


def train(records: list[list[tuple[str, str]]], known: Gazetteer, companies: frozenset[str] = frozenset()) -> Field:
    """The field of the sample's records; each is the (text, field) pairs of one document."""
    counts = Counter(w for texts in records for text, field in texts if field == "description" for w in set(re.findall(rf"(?<![{_LETTER}])[a-zà-ÿ]{{2,}}(?![{_LETTER}])", text)))
    ordinary = frozenset(w for w, n in counts.items() if n > 1)
    docs = [Document(texts, known) for texts in records]
    # Names that stand in a sure context are names elsewhere too.
    sure: Counter[str] = Counter()
    for doc in docs:
        found = {w.lower() for (text, field), hits in zip(doc.texts, doc.hits) for s, e, kind, v in judge(text, field, hits, known, ordinary, companies) if kind == "person" and v == YES for w in re.findall(rf"[{_LETTER}]{{3,}}", text[s:e])}
        sure.update(found - ordinary)
    names = frozenset(sure)
    may = []
    for doc in docs:
        verdicts = [judge(text, field, hits, known, ordinary, companies, names) for (text, field), hits in zip(doc.texts, doc.hits)]
        may.append([_label_sets(doc, n, verdicts[place[0]]) for n, place in enumerate(doc.places)])
    field = Field()
    segments = [pair for doc, sets in zip(docs, may) for pair in zip(doc.rows, sets)]
    if segments:
        field.fit_chains(segments)
        field.fit_skips(docs, may)
    return field


def exact_bounds(spans: list[tuple[int, int, str]], found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The labelled spans with the bounds of the hits of their kind; spans over no hit are dropped."""
    out = set()
    for s, e, kind in spans:
        near = [(min(e, fe) - max(s, fs), fs, fe) for fs, fe, fk in found if fk == kind and fs < e and s < fe]
        if near:
            _, fs, fe = max(near)
            out.add((fs, fe, kind))
    kept: list[tuple[int, int, str]] = []
    for s, e, kind in sorted(out, key=lambda x: (x[0], -x[1])):
        if not kept or s >= kept[-1][1]:
            kept.append((s, e, kind))
    return kept


def redact(text: str | None, spans: list[tuple[int, int, str]]) -> str | None:
    if text is None:
        return None
    out, at = [], 0
    for s, e, kind in sorted(spans):
        if s >= at:
            out += [text[at:s], PLACEHOLDERS[kind]]
            at = e
    return "".join(out) + text[at:]


_TEXTS = ("description", "address_raw")


def find_personal(listings: DataFrame, training_texts: int = TRAINING_TEXTS) -> DataFrame:
    """``rec, description, address_raw, found``: redacted texts and the pieces found in them.

    ``listings`` needs rec, comune, description, address_raw and agency_name, one row per rec.
    ``found`` is an array of (field, kind, span_start, span_end). NULL and empty texts
    have no pieces and stay as they are; texts of any length are read whole. Both
    texts of a listing are one document for the skip edges. An empty table gives an
    empty result.
    """
    spark = listings.sparkSession
    source = cut_lineage(listings.select("rec", "comune", "agency_name", *_TEXTS))

    @F.pandas_udf("string")
    def one_name(texts: pd.Series) -> pd.Series:
        return texts.map(comune_name)

    names = cut_lineage(source.where(F.col("comune").isNotNull()).select("comune").distinct().select(one_name("comune").alias("name")).distinct())
    if not small_enough(names):
        raise ValueError("more different comuni than a country can have")
    known = Gazetteer({r.name for r in names.collect()} - {""}, {})
    sample: dict[str, dict[str, str]] = {}
    companies = set()
    for field, share in (("description", 3), ("address_raw", 6)):
        rows = source.where(F.trim(field) != "").select("rec", "agency_name", field).orderBy(F.xxhash64("rec"), "rec").limit(max(1, training_texts * share // 9)).toPandas()
        for rec, agency, text in zip(rows["rec"], rows["agency_name"], rows[field]):
            sample.setdefault(rec, {})[field] = text
            companies.add(" ".join(re.findall(rf"[{_LETTER}]+", (agency or "").lower())))
    records = [[(texts[f], f) for f in _TEXTS if f in texts] for texts in sample.values()]
    model = spark.sparkContext.broadcast((train(records, known, frozenset(companies)), known))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field, gazetteer = model.value
        for batch in batches:
            for low in range(0, len(batch), 1000):
                part = batch.iloc[low : low + 1000]
                docs = [Document([(t if isinstance(t, str) else "", f) for t, f in zip(texts, _TEXTS)], gazetteer) for texts in zip(*(part[f] for f in _TEXTS))]
                bounded = [[exact_bounds(spans, hits) for spans, hits in zip(of_doc, doc.hits)] for of_doc, doc in zip(field.spans(docs), docs)]
                yield pd.DataFrame({
                    "rec": part["rec"].to_numpy(),
                    **{f: [redact(t, b[k]) for t, b in zip(part[f], bounded)] for k, f in enumerate(_TEXTS)},
                    "found": [[{"field": f, "kind": kind, "span_start": s, "span_end": e} for k, f in enumerate(_TEXTS) for s, e, kind in b[k]] for b in bounded],
                })

    pieces = "array<struct<field:string,kind:string,span_start:int,span_end:int>>"
    return source.select("rec", *_TEXTS).mapInPandas(run, f"rec string, description string, address_raw string, found {pieces}")
