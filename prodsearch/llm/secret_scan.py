"""Secret scans: known patterns plus a randomness test battery.

The patterns find assigned values, access keys and long hex strings. Beside
them every long token that is no mere number is a candidate, also right after
a ``=`` and inside a URL, where the parts of a path are tried one by one if the
whole is not random: its encoding is inferred from its characters, and three tests ask whether it
looks drawn at random from that alphabet: chi-squared uniformity, runs about
the alphabet's middle, and lag-1 serial correlation. "Random" is the claim to
be controlled, so each candidate gets the p-value that ordinary text would
look this random, from how often ordinary words of its length do, and the
claims of a length band pass a false-discovery threshold over all documents.
A random token stays a span of its own unless one pattern's span holds it whole.

Defined cases: null and empty texts have no spans; whole texts are scanned,
however long; repeated rows are scanned alike; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodsearch.llm.common import map_texts

KINDS = ("assign", "access", "hex", "random")       # in the order ties are listed
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16
MIN_RANDOM = 20             # shorter tokens carry too little evidence either way
TEST_LEVEL = 0.01           # a test below this p-value finds the token not random
FDR = 0.05                  # false discoveries among the random claims of a band
BANDS = (20, 24, 32, 48, 64, 128)

ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (MIN_ACCESS - 4))
HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
# Up to two = at the end are padding; one with a value behind it is an assignment.
CANDIDATE = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?" % MIN_RANDOM)
#: What may part a random token from the words before or behind it; marks at the very end are its own.
PARTS = (re.compile(r"[^/]+(?:/+=*\Z)?"), re.compile(r"[^/_-]+(?:[/_-]+=*\Z)?"))

_HEX = "0123456789abcdef"
_UPPER, _LOWER, _DIGIT = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Encodings from the narrowest alphabet to the widest.
ALPHABETS = (
    ("hex", _HEX), ("HEX", _HEX.upper()), ("lower26", _LOWER), ("upper26", _UPPER),
    ("base32", _UPPER + "234567"), ("lower36", _DIGIT + _LOWER), ("upper36", _DIGIT + _UPPER),
    ("letters52", _UPPER + _LOWER), ("base62", _DIGIT + _UPPER + _LOWER),
    ("base64", _UPPER + _LOWER + _DIGIT + "+/"), ("base64url", _UPPER + _LOWER + _DIGIT + "-_"),
)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches. The assign pattern takes
    the whole value before its length is judged, so a short value still
    uses up its text."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


def encoding(token: str) -> tuple[str, str] | None:
    """(name, alphabet) of the narrowest encoding that holds the token; none
    for tokens of digits only, which numbers are too."""
    chars = set(token.rstrip("="))
    if not chars - set(_DIGIT):
        return None
    return next(((n, a) for n, a in ALPHABETS if chars <= set(a)), None)


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail of chi-squared by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def uniformity_p(at: list[int], size: int) -> float:
    """Chi-squared over as many equal classes of the alphabet as give five
    expected characters each (two at least)."""
    k = max(2, min(size, len(at) // 5))
    # classes differ in width by one where k does not divide the alphabet
    width = [0] * k
    for c in range(size):
        width[c * k // size] += 1
    seen = [0] * k
    for a in at:
        seen[a * k // size] += 1
    x = sum((s - len(at) * w / size) ** 2 / (len(at) * w / size) for s, w in zip(seen, width))
    return _chi2_tail(x, k - 1)


def runs_p(at: list[int], size: int) -> float:
    """Wald-Wolfowitz runs above and below the alphabet's middle, two-sided."""
    high = [2 * a >= size for a in at]
    n1 = sum(high)
    n2 = len(high) - n1
    n = n1 + n2
    if not n1 or not n2 or n < 3:
        return 0.0
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    mean = 2 * n1 * n2 / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    return _normal_tail((runs - mean) / math.sqrt(var)) if var > 0 else 0.0


def serial_p(at: list[int]) -> float:
    """Lag-1 serial correlation, two-sided normal approximation."""
    n = len(at)
    mean = sum(at) / n
    var = sum((a - mean) ** 2 for a in at)
    if not var:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(at, at[1:])) / var
    return _normal_tail((r + 1 / n) * math.sqrt(n))


def class_changes_p(token: str) -> float:
    """How likely ordinary text changes character class (lower, upper, digit)
    as often: it does so about once in eight characters. Changes at a
    separator don't count."""
    kind = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "" for c in token]
    changes = sum(a != b and a != "" != b for a, b in zip(kind, kind[1:]))
    return _binomial_tail(changes, len(kind) - 1, 1 / 8)


def _binomial_tail(seen: int, n: int, p: float) -> float:
    if n > 400:
        return 0.5 * math.erfc((seen - n * p) / math.sqrt(2 * n * p * (1 - p)))
    tail, term = 0.0, (1 - p) ** n
    for k in range(n + 1):
        if k >= seen:
            tail += term
        term *= (n - k) / (k + 1) * p / (1 - p)
    return min(1.0, tail)


def rare_letters_p(token: str) -> float:
    """How likely ordinary words hold as many of the letters jkqvwxyz: about
    one letter in twelve of theirs at most is one, of random ones three in ten."""
    letters = [c for c in token.lower() if c in _LOWER]
    return _binomial_tail(sum(c in "jkqvwxyz" for c in letters), len(letters), 1 / 10)


def ordinary_p(body: str) -> float:
    """The p-value of the changes of character class; for tokens without a
    digit, whose words may be joined by capitals, combined with that of the
    letters themselves (Fisher)."""
    p = class_changes_p(body)
    if set(body) & set(_DIGIT):
        return p
    both = p * rare_letters_p(body)
    return both * (1 - math.log(both)) if both > 0 else 0.0


def battery(token: str) -> float | None:
    """The p-value that ordinary text looks as random as the token; none if
    it is no candidate or a test (Bonferroni over three) finds it not random."""
    enc = encoding(token)
    if enc is None:
        return None
    body, place = token.rstrip("="), {c: i for i, c in enumerate(enc[1])}
    at = [place[c] for c in body]
    tests = (uniformity_p(at, len(place)), runs_p(at, len(place)), serial_p(at))
    return None if 3 * min(tests) < TEST_LEVEL else ordinary_p(body)


def band(length: int) -> int:
    return sum(length >= b for b in BANDS)


CELLS = 64                  # p-values in quarter decades: cell c holds p <= 10 ** (-c / 4)


def _cell(p: float) -> int:
    return min(CELLS - 1, int(-4 * math.log10(max(p, 1e-300))))


def false_discovery_cells(counts: list[tuple[int, int, int]], fdr: float = FDR) -> dict[int, int]:
    """Benjamini-Hochberg by length band from (band, cell, number): the
    smallest cell whose claims are passed; a band without one is left out."""
    out = {}
    for b in {b for b, _, _ in counts}:
        cells = {c: n for x, c, n in counts if x == b}
        total = sum(cells.values())
        passed = 0
        for c in sorted(cells, reverse=True):
            passed += cells[c]
            if total * 10 ** (-c / 4) <= fdr * passed:
                out[b] = c
    return out


def claims(text: str | None) -> list[tuple[int, int, int, int]]:
    """(start, end, band, cell) of the tokens that pass the test battery and
    lie in no pattern's span."""
    out = []
    for m in CANDIDATE.finditer(text or ""):
        out += _random_in(m[0], m.start(), PARTS)
    if out:
        base = base_spans(text)
        out = [c for c in out if not any(s <= c[0] and c[1] <= e for s, e, _ in base)]
    return out


def _random_in(token: str, at: int, parts: tuple) -> list[tuple[int, int, int, int]]:
    """The token, or if the battery finds it not random, the parts that pass."""
    p = battery(token)
    if p is not None:
        return [(at, at + len(token), band(len(token)), _cell(p))]
    out = []
    for k, part in enumerate(parts):
        found = [m for m in part.finditer(token) if len(m[0]) >= MIN_RANDOM]
        if [m[0] for m in found] != [token]:
            for m in found:
                out += _random_in(m[0], at + m.start(), parts[k + 1:])
            break
    return out


def discovery_cells(docs: DataFrame, text: str = "text") -> dict[int, int]:
    """The false-discovery threshold of each length band over all documents.
    At most bands x cells rows reach the driver."""
    def make():
        def of(texts: list) -> dict:
            rows = [(i, *c[2:]) for i, t in enumerate(texts) for c in claims(t)]
            return {n: [r[k] for r in rows] for k, n in enumerate(("at", "band", "cell"))}
        return of

    found = map_texts(docs, [], text, make, {"band": "int", "cell": "int"})
    return false_discovery_cells([tuple(r) for r in found.groupBy("band", "cell").count().collect()])


def joined(spans: list[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then kind as listed."""
    order = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{k}:{s}:{e}" for s, e, k in order)


def random_spans(text: str | None, cells: dict[int, int]) -> list[tuple[int, int, str]]:
    return [(s, e, "random") for s, e, b, c in claims(text) if b in cells and c >= cells[b]]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base (the pattern spans as
    kind:start:end, code points) and spans (those and the random ones)."""
    cells = discovery_cells(docs, text)

    def make():
        def of(texts: list) -> dict:
            base = [base_spans(t) if t else [] for t in texts]
            every = [b + random_spans(t, cells) for b, t in zip(base, texts)]
            out = {"n_" + k: [sum(s[2] == k for s in b) for b in base] for k in KINDS[:3]}
            return out | {"base": [joined(b) for b in base], "spans": [joined(x) for x in every]}
        return of

    return map_texts(docs, [doc_id], text, make, {
        "n_assign": "long", "n_access": "long", "n_hex": "long", "base": "string", "spans": "string"})


def redact(text: str, spans: list[tuple[int, int, str]], mark: str) -> str:
    """The text with each span (overlapping ones together) replaced by ``mark``."""
    out, done = [], 0
    for s, e, _ in sorted(spans):
        if s >= done:
            out += [text[done:s], mark]
        done = max(done, e)
    return "".join(out) + text[done:]


def without_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret span replaced by ``mark``; the columns of
    ``docs`` only (``n_chars``, where there is one, follows the new text)."""
    cells = discovery_cells(docs, text)

    def make():
        def of(texts: list) -> dict:
            return {"__clean": [t and redact(t, base_spans(t) + random_spans(t, cells), mark)
                                for t in texts]}
        return of

    others = [c for c in docs.columns if c != text]
    clean = map_texts(docs, others, text, make, {"__clean": "string"}).withColumnRenamed("__clean", text)
    if "n_chars" in others:
        clean = clean.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)
