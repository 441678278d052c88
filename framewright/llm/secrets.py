"""Operator 6: secret scans with multipart credential linking, in DataFrame functions only.

Base spans are the matches of three fixed patterns. A match's place is a running sum over the lengths
of the matches and of the gaps between them, so no Python is needed. Beside them, weak parts are looked
for: identifiers (user names, client ids, access ids), bare 40-character keys, and endpoints. A weak
part alone says nothing; it is reported only where complementary parts meet within a scope: an
interval join of the parts' spans, widened by the scope, inside each document. A bare key needs an
access identifier or an endpoint near it, an identifier needs a secret, an endpoint needs both.
Scopes never cross documents, so the join needs no shuffle and a hot source costs nothing extra.

The join searches the ordered starts and ends of the other parts by halving, running sums and maxima go
by doubling, and every pattern is anchored, so a document of n characters and m matches takes about
n + m log m steps.

Null and empty texts have no spans. Rows are independent: repeated rows, null ids and extra columns
need no special treatment. Places are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base spans; group 2 of the first is its value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
IDENT = r"""(?i)(?:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.-]{3,}"""
KEY = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/])"
ENDPOINT = r"""[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9][^\s"'<>]*"""
#: The same from the start of a run of a scheme's characters, of which group 1 is what comes before its first letter: so each run is tried once.
ENDPOINT_RUN = r"""(?<![A-Za-z0-9+.-])([0-9+.-]*+)[A-Za-z][A-Za-z0-9+.-]*+://[A-Za-z0-9][^\s"'<>]*"""
KINDS = ("assign", "access", "hex", "key", "ident", "endpoint")
SCOPE = 256
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array of numbers by doubling: each round combines entries twice as far apart."""
    rounds = F.ceil(F.log2(F.size(values))).cast("int")
    steps = F.when(F.size(values) > 1, F.transform(F.sequence(F.lit(0), rounds - 1), lambda j: F.pow(F.lit(2), j).cast("int")))
    reach = lambda acc, step: F.transform(acc, lambda x, i: F.when(i >= step, combine(x, F.get(acc, i - step))).otherwise(x))
    return F.coalesce(F.aggregate(steps, values, reach), values)


def _upto(values: Column, x: Column) -> Column:
    """How many of the ascending ``values`` are ``x`` or less, by halving."""
    steps = F.array(*(F.lit(1 << j) for j in range(29, -1, -1)))
    return F.aggregate(steps, F.lit(0), lambda at, s: F.when((at + s <= F.size(values)) & (F.get(values, at + s - 1) <= x), at + s).otherwise(at))


def _placed(parts: Column, kind: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """Spans from an array of (m, g[, v]): a match's length, the length of the gap before it, the value to test."""

    def spans(p: Column) -> Column:
        ends = _running(F.transform(p, lambda x: x["g"] + F.coalesce(x["m"], F.lit(0))), lambda x, y: x + y)
        found = F.zip_with(p, ends, lambda x, end: F.struct(x.alias("x"), end.alias("end")))
        good = lambda s: s["x"]["m"].isNotNull() if keep is None else s["x"]["m"].isNotNull() & keep(s["x"]["v"])
        return F.transform(F.filter(found, good), lambda s: F.struct((s["end"] - s["x"]["m"]).alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    return _let(parts, spans)


def _spans(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column] | None = None, value_group: int = 0) -> Column:
    """Spans of all matches that ``keep`` (a test of the value group) accepts."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    columns = [F.transform(matches, F.char_length).alias("m"), gaps.alias("g")]
    if keep is not None:
        columns.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("v"))
    return F.when(text.rlike(pattern), _placed(F.arrays_zip(*columns), kind, keep)).otherwise(F.array().cast(_SPANS))


def _endpoints(text: Column, kind: int) -> Column:
    """Spans of ``ENDPOINT``."""
    lengths = lambda group: F.transform(F.regexp_extract_all(text, F.lit(ENDPOINT_RUN), F.lit(group)), F.char_length)
    gaps = F.transform(F.split(text, ENDPOINT_RUN, -1), F.char_length)
    split = lambda x: F.struct((x["all"] - x["lead"]).alias("m"), (x["g"] + F.coalesce(x["lead"], F.lit(0))).alias("g"))
    parts = F.transform(F.arrays_zip(lengths(0).alias("all"), lengths(1).alias("lead"), gaps.alias("g")), split)
    return F.when(text.contains("://"), _placed(parts, kind)).otherwise(F.array().cast(_SPANS))


def _ordered(spans: Column) -> Column:
    """The ascending starts and ends of spans, for ``_near``."""
    return F.struct(F.array_sort(F.transform(spans, lambda b: b["start"])).alias("starts"), F.array_sort(F.transform(spans, lambda b: b["end"])).alias("ends"))


def _near(a: Column, others: Column, scope: int) -> Column:
    """Does a span of ``others`` lie within ``scope`` of ``a`` without sharing characters with it? Only the last
    that ends before ``a`` and the first that starts after it can be nearest."""
    before = _let(_upto(others["ends"], a["start"]), lambda n: (n > 0) & (F.get(others["ends"], n - 1) >= a["start"] - scope))
    after = F.get(others["starts"], _upto(others["starts"], a["end"] - 1)) <= a["end"] + scope
    return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))


def _linked(s: Column, scope: int) -> Column:
    """The weak parts of ``s`` that complementary parts stand near."""
    sides = F.struct(_ordered(F.concat(s["access"], s["ident"])).alias("ids"), _ordered(s["endpoint"]).alias("endpoints"))

    def with_key(o: Column, key: Column) -> Column:
        def parts(secret: Column) -> Column:
            ident = F.filter(s["ident"], lambda a: _near(a, secret, scope))
            endpoint = F.filter(s["endpoint"], lambda a: _near(a, secret, scope) & _near(a, o["ids"], scope))
            return F.array_sort(F.concat(key, ident, endpoint))

        return _let(_ordered(F.concat(s["assign"], s["hex"], key)), parts)

    keys = lambda o: F.filter(s["key"], lambda a: _near(a, o["ids"], scope) | _near(a, o["endpoints"], scope))
    found = _let(sides, lambda o: _let(keys(o), lambda key: with_key(o, key)))
    weak = F.size(s["key"]) + F.size(s["ident"]) + F.size(s["endpoint"])
    return F.when(weak > 0, found).otherwise(F.array().cast(_SPANS))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def scan(df: DataFrame, text_col: str = "text", scope: int = SCOPE, into: str = "__secrets") -> DataFrame:
    """``df`` with a struct column ``into``: assign, access, hex, linked, each an array of spans in order."""
    # Catalyst copies an expression wherever its column is used; one struct per step keeps each scan single.
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    shaped = lambda v: v.rlike("[A-Z]") & v.rlike("[a-z]") & v.rlike("[0-9]")
    found = df.withColumn(
        into,
        F.struct(
            _spans(text, ASSIGN, 0, lambda v: F.char_length(v) >= 8, 2).alias("assign"),
            F.when(text.contains("AKIA"), _spans(text, ACCESS, 1)).otherwise(F.array().cast(_SPANS)).alias("access"),
            _spans(text, HEX, 2).alias("hex"),
            _spans(text, KEY, 3, shaped, 0).alias("key"),
            _spans(text, IDENT, 4).alias("ident"),
            _endpoints(text, 5).alias("endpoint"),
        ),
    )
    s = F.col(into)
    return found.withColumn(into, F.struct(s["assign"].alias("assign"), s["access"].alias("access"), s["hex"].alias("hex"), _linked(s, scope).alias("linked")))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every whole text."""
    found = scan(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    s = F.col("__secrets")
    base = F.array_sort(F.concat(s["assign"], s["access"], s["hex"]))
    return found.select(
        "doc_id",
        F.size(s["assign"]).cast("long").alias("n_assign"),
        F.size(s["access"]).cast("long").alias("n_access"),
        F.size(s["hex"]).cast("long").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat(base, s["linked"]))).alias("spans"),
    )


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with each reported span of the text replaced by ``mark``; overlapping spans become one."""
    found = scan(df, text_col)
    s = F.col("__secrets")
    spans = F.array_sort(F.concat(s["assign"], s["access"], s["hex"], s["linked"]))
    text = F.col(f"`{text_col}`")
    # The text in pieces of 1,024 characters, so that a place is reached without reading all that stands before it.
    lot = 10
    lots = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << lot}}}"), F.lit(0))

    def replaced(x: Column) -> Column:
        def cut(a: Column, b: Column) -> Column:
            first, last, skip = F.shiftright(a, lot), F.shiftright(b, lot), a.bitwiseAND((1 << lot) - 1)
            at = lambda i: F.coalesce(F.get(x["lots"], i), F.lit(""))
            apart = F.concat(at(first).substr(skip + 1, F.lit(1 << lot)), F.array_join(F.slice(x["lots"], first + 2, last - first - 1), ""), at(last).substr(F.lit(1), b.bitwiseAND((1 << lot) - 1)))
            return F.when(first == last, at(first).substr(skip + 1, b - a)).otherwise(apart)

        def pieces(reach: Column) -> Column:
            before = lambda i: F.coalesce(F.when(i > 0, F.get(reach, i - 1)), F.lit(0))
            piece = lambda span, i: F.when(span["start"] >= before(i), F.concat(cut(before(i), span["start"]), F.lit(mark))).otherwise("")
            rest = cut(F.element_at(reach, -1), x["size"])
            return F.array_join(F.concat(F.transform(x["spans"], piece), F.array(rest)), "")

        return _let(_running(F.transform(x["spans"], lambda span: span["end"]), F.greatest), pieces)

    whole = F.struct(spans.alias("spans"), lots.alias("lots"), F.char_length(text).alias("size"))
    clean = F.when(F.size(spans) > 0, _let(whole, replaced)).otherwise(text)
    return found.withColumn(text_col, clean).drop("__secrets")
