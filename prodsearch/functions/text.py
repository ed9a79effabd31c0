"""Column-expression builders for text, numbers and formatting.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``,
so it stays inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S

# Unicode-aware whitespace at either end (Spark's ``trim`` strips only ' ').
# Python's str.isspace() set: Unicode White_Space plus the four information
# separators U+001C..U+001F, which Java's (?U)\s leaves out.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
# A plain decimal number, optionally signed, with exponent and padding.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Infinity as pandas' parser spells it: any case, optional sign, no padding.
_INFINITY = r"(?i)^[+-]?inf(inity)?$"
# Tokens a CSV reader should treat as missing (pandas default list).
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
               "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
               "n/a", "nan", "null"]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Strip all Unicode whitespace from both ends (like ``str.strip()``)."""
    return F.regexp_replace(col_of(c), _EDGE_SPACE, "")


def null_if_token(c: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Turn the missing-value tokens of a CSV cell into null."""
    c = col_of(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


def to_number(c: str | Column) -> Column:
    """Text to double like ``pandas.to_numeric(errors='coerce')``: a plain
    decimal number (ASCII padding allowed) or an unpadded ``inf`` /
    ``infinity`` literal; anything else, and a number too large for a
    double, becomes null.

    ``try_cast`` alone is too lenient (``1.5d``, ``NaN``), so the text is
    first checked against a plain-number pattern.
    """
    c = col_of(c)
    as_text = c.cast("string")
    num = strip(as_text).try_cast("double")
    inf = F.lit(float("inf"))
    return (F.when(as_text.rlike(_NUMBER), F.when(F.abs(num) != inf, num))
            .when(as_text.rlike(_INFINITY),
                  F.when(as_text.startswith("-"), -inf).otherwise(inf)))


def blank_clean(c: str | Column) -> Column:
    """Null to blank, then strip."""
    return F.coalesce(strip(col_of(c)), F.lit(""))


def is_available(c: str | Column) -> Column:
    """Non-null and non-blank after stripping."""
    c = col_of(c)
    return c.isNotNull() & (strip(c) != "")


def is_filled(c: str | Column) -> Column:
    """Truthy as a field value: not null and not blank."""
    c = col_of(c)
    return c.isNotNull() & (strip(c.cast("string")) != "")


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable,
    so an expression that uses it several times does not repeat its tree."""
    return F.transform(F.array(value), body)[0]


def py_number_text(c: str | Column) -> Column:
    """Render a double the way Python's ``str(float)`` does.

    The significant digits come from Spark's own double-to-text cast (the
    shortest form that reads back to the same double); only the layout is
    redone: Python writes exponents -4..15 in fixed notation
    (``0.00064``, ``12345678.9``, ``10000000.0``) and others as ``1e+16``,
    ``1.5e-05``, where Java switches at 1e-3 and 1e7 and writes ``1.0E7``.
    nan and inf print as Python does. Java 17's cast sometimes gives 17
    digits where fewer read back (e.g. -2**-24); then the 15- or 16-digit
    ``%e`` form that reads back to the same double is used instead.
    """
    def parts(t):
        # Java: [-]<int>.<frac>[E<exp>], or %e: [-]<d>.<frac>e<+|-><exp>
        return F.struct(
            t.startswith("-").alias("neg"),
            F.regexp_extract(t, r"^-?(\d+)", 1).alias("ip"),
            F.regexp_extract(t, r"\.(\d+)", 1).alias("fp"),
            F.coalesce(F.nullif(F.regexp_extract(t, r"[eE]([+-]?\d+)", 1), F.lit("")).cast("int"),
                       F.lit(0)).alias("e"))

    def significant(p):
        raw = F.concat(p["ip"], p["fp"])
        lead = F.length(raw) - F.length(F.regexp_replace(raw, "^0+", ""))
        digits = F.regexp_replace(F.regexp_replace(raw, "^0+", ""), "0+$", "")
        return F.struct(p["neg"].alias("neg"), digits.alias("d"),
                        (p["e"] + F.length(p["ip"]) - 1 - lead).alias("x"))

    def layout(q):
        d, x = q["d"], q["x"]
        nd = F.length(d)
        fixed_pos = F.concat(F.rpad(d, F.greatest(nd, x + 1), "0").substr(F.lit(1), x + 1),
                             F.lit("."),
                             F.when(nd > x + 1, d.substr(x + 2, nd)).otherwise(F.lit("0")))
        fixed_neg = F.concat(F.lit("0."), F.repeat(F.lit("0"), -x - 1), d)
        sci = F.concat(d.substr(1, 1),
                       F.when(nd > 1, F.concat(F.lit("."), d.substr(F.lit(2), nd))).otherwise(
                           F.lit("")),
                       F.when(x < 0, F.lit("e-")).otherwise(F.lit("e+")),
                       F.when(F.abs(x) < 10, F.lit("0")).otherwise(F.lit("")),
                       F.abs(x).cast("string"))
        laid = (F.when(d == "", F.lit("0.0"))
                .when((x >= 0) & (x < 16), fixed_pos)
                .when((x < 0) & (x >= -4), fixed_neg)
                .otherwise(sci))
        return F.concat(F.when(q["neg"], F.lit("-")).otherwise(F.lit("")), laid)

    x = col_of(c).cast("double")
    a = F.abs(x)
    inf = float("inf")
    # Java and Python agree on zero and on 1e-3 <= |x| < 1e7; whole numbers
    # below 1e16 are the integer plus ".0"; the rest of 1e-4 <= |x| < 1e16
    # goes through a decimal. Only exponent notation (CASE WHEN is lazy)
    # pays for the interpreted re-layout.
    t = x.cast("string")
    # 17 significant digits (only possible in texts of 18+ characters)
    long17 = (F.length(t) >= 18) & (F.length(F.regexp_replace(
        F.regexp_replace(t, r"E.*$|[-.]", ""), r"^0+|0+$", "")) >= 17)
    e15, e16 = F.format_string("%.14e", x), F.format_string("%.15e", x)
    shorter = F.when(e15.cast("double") == x, e15).when(e16.cast("double") == x, e16)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("nan"))
            .when(x == F.lit(inf), F.lit("inf"))
            .when(x == F.lit(-inf), F.lit("-inf"))
            .when(long17 & shorter.isNotNull(),
                  _let(_let(_let(shorter, parts), significant), layout))
            .when((x == 0) | ((a >= 1e-3) & (a < 1e7)), t)
            .when((x == F.floor(x)) & (a < 1e16), F.concat(x.cast("long").cast("string"), F.lit(".0")))
            # the rest of Python's fixed range: a decimal cast keeps the same
            # digits in plain notation; trailing zeros of the scale go
            .when((a >= 1e-4) & (a < 1e16), F.regexp_replace(F.regexp_replace(
                x.cast("decimal(38,22)").cast("string"), "0+$", ""), "[.]$", ".0"))
            .otherwise(_let(_let(_let(x.cast("string"), parts), significant), layout)))


def value_text(c: Column, dtype: str, fmt: str | None = None) -> Column:
    if fmt:
        m = re.fullmatch(r"%\.([0-7])f", fmt)
        if m:
            return fixed(c, int(m.group(1)))
        return F.when(c.isNotNull(), F.format_string(fmt, c))
    if dtype in ("double", "float"):
        return py_number_text(c)
    return c.cast("string")


def search_text(df_columns: dict[str, str], spec: Sequence[tuple],
                missing: str = S.MISSING_TEXT, null_text: str | None = None) -> Column:
    """Newline-joined ``label: value[unit]`` lines, stripped.

    ``df_columns`` maps the frame's column names to their simple type names.
    A spec entry is (label, column, unit) or (label, column, unit, printf
    format); column None makes a heading line. A column absent from the
    frame renders ``missing``; a null cell renders ``null_text`` (default:
    also ``missing``; the original pipeline printed ``nan``).
    """
    null_text = missing if null_text is None else null_text
    lines = []
    for entry in spec:
        label, column, unit = entry[0], entry[1], entry[2]
        fmt = entry[3] if len(entry) > 3 else None
        if column is None:
            lines.append(F.lit(f"{label}:"))
            continue
        if column in df_columns:
            v = F.coalesce(value_text(F.col(column), df_columns[column], fmt), F.lit(null_text))
        else:
            v = F.lit(missing)
        lines.append(F.concat(F.lit(f"{label}: "), v, F.lit(unit)))
    return strip(F.concat_ws("\n", *lines))


def search_text_other(name: str | Column, company: str | Column,
                      null_text: str = S.MISSING_TEXT) -> Column:
    """One-line text for product types without a template."""
    (l1, _), (l2, _) = S.SEARCH_TEXT_OTHER
    return F.concat(F.lit(f"{l1}: "), F.coalesce(col_of(name).cast("string"), F.lit(null_text)),
                    F.lit(f", {l2}: "), F.coalesce(col_of(company).cast("string"), F.lit(null_text)))


def fixed(c: str | Column, digits: int = 2) -> Column:
    """``'%.<digits>f' % x`` exactly as Python prints it, JVM-side.

    Python rounds the exact binary value half-to-even; Spark's
    ``format_string`` rounds the shortest decimal form half-up, so they part
    on values such as 2.675 (stored just below 2.675: Python 2.67, Java
    2.68) and 0.125 (an exact tie: Python 0.12, Java 0.13). Here
    ``|x| * 10^digits`` is split into its rounded product ``p`` and the
    exact error ``err`` (Dekker's product with a Veltkamp split, plain
    double arithmetic); ``p`` decides the rounding unless it ends in exactly
    .5, where the sign of ``err`` decides and a true tie goes to even.
    Covers ``|x| < 2^52 / 10^digits`` and digits 0-7; larger magnitudes
    fall back to ``format_string``. nan and inf print as Python does.
    """
    if not 0 <= digits <= 7:
        raise ValueError("digits must be 0-7")
    x = col_of(c).cast("double")
    scale = float(10 ** digits)
    a = F.abs(x)
    split = a * F.lit(134217729.0)          # 2^27 + 1
    a_hi = split - (split - a)
    a_lo = a - a_hi
    prod = a * F.lit(scale)
    err = (a_hi * F.lit(scale) - prod) + a_lo * F.lit(scale)
    whole = F.floor(prod)
    frac = prod - whole
    up = ((frac > 0.5) | ((frac == 0.5) & ((err > 0) | ((err == 0) & (F.pmod(whole, F.lit(2)) == 1)))))
    k = whole + F.when(up, F.lit(1)).otherwise(F.lit(0))
    sign = F.when(x.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    if digits:
        body = F.concat((k / F.lit(10 ** digits)).cast("long").cast("string"), F.lit("."),
                        F.lpad(F.pmod(k, F.lit(10 ** digits)).cast("string"), digits, "0"))
    else:
        body = k.cast("string")
    inf = float("inf")
    return (F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("nan"))
            .when(x == F.lit(inf), F.lit("inf"))
            .when(x == F.lit(-inf), F.lit("-inf"))
            .when(a < F.lit(2.0 ** 52 / scale), F.concat(sign, body))
            .otherwise(F.format_string(f"%.{digits}f", x)))


def py_round(c: str | Column, digits: int) -> Column:
    """Python's ``round(x, digits)``: the double nearest to the correctly
    rounded decimal, which is ``fixed``'s text read back as a double (this is
    how Python computes it). ``F.round`` rounds half-up from the shortest
    decimal form instead (``round(0.8125, 3)``: Python 0.812, Spark 0.813)."""
    return fixed(c, digits).cast("double")


def pct_range(lo: str | Column, hi: str | Column) -> Column:
    """``x.xx% ~ y.yy%``"""
    return F.concat(fixed(lo, 2), F.lit("% ~ "), fixed(hi, 2), F.lit("%"))


def pct(c: str | Column, digits: int = 2) -> Column:
    """``x.xx%``"""
    return F.concat(fixed(c, digits), F.lit("%"))


def cut(c: str | Column, n: int, suffix: str = "...") -> Column:
    """First ``n`` characters plus a suffix."""
    return F.concat(F.substring(col_of(c), 1, n), F.lit(suffix))


def contains_any(text: str | Column, keywords: Iterable[str], lower: bool = True) -> Column:
    """True when any keyword occurs in the (lower-cased) text."""
    t = F.lower(col_of(text)) if lower else col_of(text)
    kws = list(keywords)
    if not kws:
        return F.lit(False)
    out = t.contains(kws[0])
    for k in kws[1:]:
        out = out | t.contains(k)
    return out


def marker_regex(marker: str, allow_bold: bool = True) -> str:
    """Regex for a ``<emoji> <label>:`` marker; optionally ``**label**:`` too."""
    if not allow_bold:
        return r"\Q" + marker + r"\E"
    head, _, label = marker.rstrip(":").partition(" ")
    if not label:
        return r"\Q" + marker + r"\E"
    return r"\Q" + head + r"\E\s*\*{0,2}\Q" + label + r"\E\*{0,2}\s*:"


def marker_value(text: str | Column, marker_re: str) -> Column:
    """Value after the marker on the first line that holds it, up to a
    second marker on that line, stripped; null when no line holds it."""
    t = col_of(text)
    line = F.regexp_extract(t, r"[^\n]*(?:" + marker_re + r")[^\n]*", 0)
    value = F.regexp_extract(line, "(?:" + marker_re + r")((?:(?!" + marker_re + r")[^\n])*)", 1)
    return F.when(t.rlike(marker_re), strip(value))


def has_marker(text: str | Column, marker_re: str) -> Column:
    return col_of(text).rlike(marker_re)


# Amounts: an 억 part, a 만 part and a plain part, each optional and each made
# of thousands (천), hundreds (백) and a number, which may have separators and
# decimals; then 원.
_NUM = r"(\d[\d,]*(?:\.\d+)?)"
_PART = rf"(?:{_NUM}\s*천)?\s*(?:{_NUM}\s*백)?\s*{_NUM}?"
_AMOUNT = rf"(?=\d)(?:{_PART}\s*억)?\s*(?:{_PART}\s*만)?\s*{_PART}\s*원"
# Periods: years (with decimals) that may be followed by a half or by months,
# months alone, or half a year. Four digits before 년 are a calendar year.
_PERIOD = (r"(?<![\d.])(?:(\d{1,3}(?:\.\d+)?)\s*년(?:간)?(?:\s*(?:(반)(?=$|[^가-힣]|간|이|을|은|의|으로|정도|동안|짜리|만|부터|까지)"
           r"|(\d+)\s*(?:개월|달)))?|(\d+)\s*(?:개월|달)|(반)년)")


def _groups(mention: Column, pattern: str, n: int) -> Column:
    """The n groups of a text that the pattern matches whole, '' for those
    without a part in it."""
    return F.split(F.regexp_replace(mention, pattern, "|".join(f"${k + 1}" for k in range(n))), r"\|")


def _won(mention: Column) -> Column:
    """An amount's text in won; null when it does not fit a long."""
    scales = [F.lit(unit * scale).cast("decimal(12,0)")
              for unit in (S.AMOUNT_UNITS["억"], S.AMOUNT_UNITS["만"], 1) for scale in (1000, 100, 1)]
    # wide enough for any of the nine numbers and their sum; null for a number that does not fit
    parts = F.zip_with(_groups(mention, _AMOUNT, 9), F.array(*scales), lambda x, s: F.when(
        x == "", F.lit(0).cast("decimal(35,6)")).otherwise(
        F.replace(x, F.lit(","), F.lit("")).try_cast("decimal(22,6)") * s))
    total = F.aggregate(parts, F.lit(0).cast("decimal(38,6)"), lambda a, x: (a + x).cast("decimal(38,6)"))
    return F.floor(total).try_cast("long")


def amounts_won(text: str | Column) -> Column:
    """Every money amount of a text in won, in order (억 = 1e8, 만 = 1e4,
    천 = 1e3, 백 = 1e2; ``1,000만``, ``1.5억``, ``3천만``), fractions of a won cut
    off; null for one that does not fit a long, an empty array for a text without."""
    return F.transform(F.regexp_extract_all(col_of(text), F.lit(_AMOUNT), F.lit(0)), _won)


def amount_won(text: str | Column) -> Column:
    """First money amount in won (see ``amounts_won``); null when there is
    none or it does not fit."""
    return _won(F.nullif(F.regexp_extract(col_of(text), _AMOUNT, 0), F.lit("")))


def _months(mention: Column) -> Column:
    """A period's text in months: years, half a year and months summed, a
    part of a month cut off; null when it does not fit an int."""
    year = S.PERIOD_UNITS["년"]

    def part(x, i):
        scale = F.element_at(F.array(*[F.lit(v).cast("decimal(4,0)") for v in (year, 0, 1, 1, 0)]), i + 1)
        number = F.when(x == "반", F.lit(year // 2).cast("decimal(26,6)")).otherwise(
            x.try_cast("decimal(22,6)") * scale)
        return F.when(x == "", F.lit(0).cast("decimal(26,6)")).otherwise(number)

    total = F.aggregate(F.transform(_groups(mention, _PERIOD, 5), part), F.lit(0).cast("decimal(38,6)"),
                        lambda a, x: (a + x).cast("decimal(38,6)"))
    return F.floor(total).try_cast("int")


def periods_months(text: str | Column) -> Column:
    """Every period of a text in months, in order: ``2년 6개월`` is 30,
    ``1년 반`` 18, ``1.5년`` 18, ``반년`` 6, ``6달`` 6; a calendar year
    (``2024년``) is none. Null for one that does not fit an int."""
    return F.transform(F.regexp_extract_all(col_of(text), F.lit(_PERIOD), F.lit(0)), _months)


def period_months(text: str | Column) -> Column:
    """First period in months (see ``periods_months``)."""
    return _months(F.nullif(F.regexp_extract(col_of(text), _PERIOD, 0), F.lit("")))


def route_intent(intent: str | Column, text: str | Column,
                 info_keywords: Sequence[str] = S.INFORMATION_KEYWORDS,
                 comparison_keywords: Sequence[str] = S.COMPARISON_KEYWORDS,
                 default_intent: str = S.DEFAULT_INTENT) -> Column:
    """information / comparison / recommendation, in that order of checks."""
    i = F.coalesce(col_of(intent), F.lit(default_intent))
    return (F.when((i == "information") | contains_any(text, info_keywords), F.lit("information"))
            .when((i == "comparison") | contains_any(text, comparison_keywords), F.lit("comparison"))
            .otherwise(F.lit("recommendation")))


def template(parts: Sequence[str | tuple[str, str]]) -> Column:
    """Concatenate literal strings and ("col", name) slots; null slots are ''."""
    cols = []
    for p in parts:
        if isinstance(p, tuple):
            cols.append(F.coalesce(F.col(p[1]).cast("string"), F.lit("")))
        else:
            cols.append(F.lit(p))
    return F.concat(*cols)


def classify_by_keywords(text: str | Column, taxonomy: Sequence[tuple[str, Sequence[str]]],
                         lower: bool = True, default: str = "") -> Column:
    """Label with the most matching keywords; ties go to the earlier label.

    Each keyword counts once per text. The taxonomy is a fixed literal, so it
    is compiled into expressions: one pass, no join, no shuffle.
    """
    t = F.lower(col_of(text)) if lower else col_of(text)
    scored = []
    for ord_, (label, kws) in enumerate(taxonomy, start=1):
        n = sum((F.when(t.contains(k.lower() if lower else k), 1).otherwise(0) for k in kws),
                F.lit(0))
        # larger n wins; among equal n the smaller ord wins
        scored.append(F.struct(n.alias("n"), F.lit(-ord_).alias("o"), F.lit(label).alias("label")))
    best = F.greatest(*scored) if len(scored) > 1 else scored[0]
    return F.when(best["n"] > 0, best["label"]).otherwise(F.lit(default))


def category_to_type(category: str | Column, rules: Sequence[tuple]) -> Column:
    """Ordered phrase rules; first match wins, else ''."""
    c = col_of(category)
    out = None
    for rule in rules:
        kind, arg, target = rule
        if kind == "contains":
            cond = c.contains(arg)
        elif kind == "equals":
            cond = c == arg
        elif kind == "contains_not":
            cond = c.contains(arg[0]) & ~c.contains(arg[1])
        elif kind == "contains_any":
            cond = contains_any(c, arg, lower=False)
        else:
            raise ValueError(f"unknown rule kind {kind!r}")
        out = F.when(cond, F.lit(target)) if out is None else out.when(cond, F.lit(target))
    if out is None:
        return F.lit("")
    return F.coalesce(out.otherwise(F.lit("")), F.lit(""))


def category_rules(compat: bool = False) -> list[tuple]:
    """The phrase rules. By default the annuity rule is checked just before
    the '저축' rule, so '연금저축' maps to annuity and every other phrase keeps
    its original result (e.g. '정기예금 연금' stays deposit); ``compat``
    keeps the original order, where the '저축' rule catches '연금저축' first
    and maps it to deposit."""
    rules = list(S.CATEGORY_RULES_LITERAL)
    if not compat:
        annuity = [r for r in rules if r[2] == "annuity"]
        rest = [r for r in rules if r[2] != "annuity"]
        at = next(i for i, r in enumerate(rest) if r[0] == "contains_not")
        rules = rest[:at] + annuity + rest[at:]
    return rules


def stamp(ts: str | Column) -> Column:
    """``yyyyMMdd_HHmmss`` (file names)."""
    return F.date_format(col_of(ts), "yyyyMMdd_HHmmss")


def shown(ts: str | Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` (reports)."""
    return F.date_format(col_of(ts), "yyyy-MM-dd HH:mm:ss")


def thousands(n: str | Column) -> Column:
    """``1,234`` style."""
    return F.format_number(col_of(n), 0)
