"""Secret scan: fixed patterns, and a randomness test battery on long tokens.

DataFrame expressions only. Three patterns give the base spans (assignments to
names like ``password``, access key ids, long hex runs). The battery takes every
token of at least ``MIN_TOKEN`` characters, infers its encoding from the characters
in it, and tests whether it looks drawn at random from that alphabet:

* chi-squared of the character counts against uniformity,
* runs above and below the middle of the alphabet,
* serial correlation at lag one.

A token stays a candidate if none of the three rejects randomness. Its p-value is
the probability that a token of ordinary writing of the same length looks as
uniform as it does: the chi-squared statistic of text whose index of coincidence
is ``IC_TEXT`` has a mean that grows with the length, so the p-value knows what a
length can tell. Benjamini-Hochberg then holds the share of false discoveries at
``FDR`` within each class of lengths, over all distinct tokens of the corpus. Its
thresholds come from counts per (length class, p-value step), at most
``len(LENGTHS) * (STEPS + 1)`` rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text

# fixed patterns, in the order of the kinds
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 6  # characters of an assigned value

MIN_TOKEN = 20
#: A token is a whole run of one alphabet (of + and /, or of - and _). A run that mixes both, such as a path that ends in a key,
#: fits no encoding as a whole and is cut: at each slash, then at each - or _ of a part that also has a +.
_RUN = rf"{{{MIN_TOKEN},}}+"
TOKEN = (rf"(?<![A-Za-z0-9+])(?=[A-Za-z0-9+/_-]{{{MIN_TOKEN}}})(?:"
         rf"(?<![/_-])(?:[A-Za-z0-9+/]{_RUN}(?![_-])|[A-Za-z0-9_-]{_RUN}(?![+/]))"
         rf"|(?<![_-])(?:[A-Za-z0-9_-]{_RUN}(?!\+)|[A-Za-z0-9+]{_RUN}(?![_-]))"
         rf"|[A-Za-z0-9+]{_RUN})={{0,2}}")
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
#: (test of the unpadded token, alphabet); the first that fits is the encoding
ENCODINGS = (
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[A-Z2-7]+$", UPPER + "234567"),
    (r"^[0-9a-z]+$", DIGITS + LOWER),
    (r"^[0-9A-Za-z]+$", UPPER + LOWER + DIGITS),
    (r"^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    (r"^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
)
#: index of coincidence of ordinary writing: letters of a European language;
#: digits of ordinary numbers for the two alphabets of mostly digits
IC_TEXT, IC_NUMBER = 0.065, 0.1
LENGTHS = (20, 24, 32, 48, 96)  # lower ends of the length classes
Z_REJECT = 3.29  # two-sided 0.1 % for each of the three tests
FDR = 0.01
STEPS = 400  # p-values in steps of a twentieth of a power of ten
MASK = "[SECRET]"


Span = "array<struct<start:int,end:int,match:string>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _located(text: Column, found: Column, pattern: str) -> Column:
    """array<struct<start, end, match>> in code points: the gaps between the
    matches and the matches themselves are laid end to end."""
    def step(acc, part):
        start = acc["at"] + F.length(part["gap"])
        end = start + F.length(part["match"])
        span = F.struct(start.alias("start"), end.alias("end"), part["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    none = F.expr(f"cast(array() as {Span})")
    parts = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(found)), found,
                       lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.size(found) > 0, spans).otherwise(none)


def _normal_below(z: Column) -> Column:
    """P(Z <= z) for z <= 0, by the rational approximation 26.2.17 of Abramowitz
    and Stegun (error under 1e-7) and the tail's bound below -5; 0.5 above 0."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = reduce(lambda acc, c: (acc + F.lit(c)) * t, (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530), F.lit(0.0))
    density = F.exp(-z * z / 2) / 2.5066282746310002
    return F.when(z >= 0, F.lit(0.5)).when(z > -5, density * poly).otherwise(density / F.abs(z))


def _encoding(token: Column) -> Column:
    """struct<alphabet, k, delta>: delta is what ordinary writing adds to the
    mean of the chi-squared statistic for each character."""
    out = F.lit(None)
    for test, alphabet in reversed(ENCODINGS):
        k = len(alphabet)
        ic = IC_NUMBER if k == 16 else IC_TEXT
        of = F.struct(F.lit(alphabet).alias("alphabet"), F.lit(float(k)).alias("k"), F.lit(k * ic - 1).alias("delta"))
        out = F.when(token.rlike(test), of).otherwise(out)
    return out


def _tested(bare: Column, alphabet: Column, k: Column, delta: Column, v: Column) -> Column:
    """struct<cls, step> of a token without padding; ``v``: its characters' places in the alphabet."""
    n = F.length(bare).cast("double")
    squares = F.aggregate(F.split(alphabet, ""), F.lit(0.0),
                          lambda acc, c: acc + F.pow((F.length(bare) - F.length(F.replace(bare, c, F.lit("")))).cast("double"), F.lit(2.0)))
    mid = (k - 1) / 2
    pairs = F.zip_with(F.slice(v, 1, F.size(v) - 1), F.slice(v, 2, F.size(v) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    runs = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + ((p["a"] > mid) != (p["b"] > mid)).cast("double"))
    serial = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + (p["a"] - mid) * (p["b"] - mid)) / ((k * k - 1) / 12)
    extra = (n - 1) * delta

    def judged(x):
        z_chi = x["over"] / F.sqrt(2 * (k - 1) * (n - 1) / n)
        z_runs = (x["runs"] - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        z_serial = x["serial"] / F.sqrt(n - 1)
        random = (F.abs(z_chi) < Z_REJECT) & (F.abs(z_runs) < Z_REJECT) & (F.abs(z_serial) < Z_REJECT)
        p = F.greatest(_normal_below((x["over"] - extra) / F.sqrt(2 * (k - 1 + 2 * extra))), F.lit(1e-30))
        cls = reduce(lambda acc, low: F.when(n >= low, F.lit(low)).otherwise(acc), LENGTHS, F.lit(0))
        return F.struct(cls.alias("cls"), F.when(random, F.least(F.floor(-20 * F.log10(p)).cast("int"), F.lit(STEPS))).alias("step"))

    return _let(F.struct((k / n * squares - n - (k - 1)).alias("over"), runs.alias("runs"), serial.alias("serial")), judged)


def battery(token: Column) -> Column:
    """struct<cls, step> of a token: its length class and its p-value in steps
    (step s: at most 10 ** (-s / 20)); the step is null if randomness is rejected.
    A token in no known encoding, or too short without its padding, has class 0."""
    def with_encoding(e):
        places = F.transform(F.split(e["bare"], ""), lambda c: (F.position(c, e["enc"]["alphabet"]) - 1).cast("double"))
        return _let(places, lambda v: _tested(e["bare"], e["enc"]["alphabet"], e["enc"]["k"], e["enc"]["delta"], v))

    none = F.struct(F.lit(0).alias("cls"), F.lit(None).cast("int").alias("step"))
    known = lambda e: F.when(e["enc"].isNull() | (F.length(e["bare"]) < MIN_TOKEN), none).otherwise(with_encoding(e))
    return _let(F.regexp_replace(token, "=+$", ""), lambda bare: _let(F.struct(bare.alias("bare"), _encoding(bare).alias("enc")), known))


def thresholds(docs: DataFrame) -> dict[int, int]:
    """Least step that counts as a discovery, for each length class, by
    Benjamini-Hochberg over the distinct tokens of all texts. A class without
    discoveries is absent."""
    tokens = docs.select(F.explode(_found(whole_text(), TOKEN)).alias("token")).distinct()
    rows = (tokens.select(battery(F.col("token")).alias("b")).where("b.cls > 0")
            .groupBy("b.cls", F.coalesce("b.step", F.lit(-1)).alias("step")).agg(F.count("*").alias("n")).collect())
    out = {}
    for cls in LENGTHS:
        counts = {r["step"]: r["n"] for r in rows if r["cls"] == cls}
        total, above = sum(counts.values()), 0
        for step in sorted(counts, reverse=True):
            above += counts[step]
            if step >= 0 and 10 ** (-step / 20) <= FDR * above / total:
                out[cls] = step
    return out


def with_spans(docs: DataFrame, least_step: dict[int, int], carry: list[str]) -> DataFrame:
    """``carry`` columns of ``docs`` with ``base`` and ``spans``: arrays of
    struct<start, kind, end>, sorted; kind is a place in ``KINDS``. ``base`` has the
    three patterns' spans, ``spans`` also the battery's where they overlap no base span."""
    text = F.col("__text")
    first = docs.select(*carry, whole_text().alias("__text")).select(
        "*", _found(text, ASSIGN).alias("__assign"), _found(text, ACCESS).alias("__access"), _found(text, HEX).alias("__hex"),
        _found(text, TOKEN).alias("__token"))
    placed = first.select(*carry, "__text", *[_located(text, F.col(c), p).alias(c) for c, p in (
        ("__assign", ASSIGN), ("__access", ACCESS), ("__hex", HEX), ("__token", TOKEN))])
    valued = F.filter("__assign", lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= MIN_VALUE)
    as_kind = lambda spans, kind: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    base = placed.select(*carry, "__text", "__token", F.array_sort(F.concat(
        as_kind(valued, 0), as_kind(F.col("__access"), 1), as_kind(F.col("__hex"), 2))).alias("base"))
    found = F.lit(False)
    of = lambda b: reduce(lambda acc, c: acc | ((b["cls"] == c[0]) & (b["step"] >= c[1])), least_step.items(), found)
    free = lambda s: ~F.exists("base", lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))
    more = F.filter("__token", lambda s: free(s) & F.coalesce(of(battery(s["match"])), F.lit(False)))
    return base.select(*carry, "__text", "base", F.array_sort(F.concat("base", as_kind(more, 3))).alias("spans"))


def _joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row.

    Spans are kind:start:end in code points, by start and kind. Null and empty
    texts have none; repeated rows give equal rows; other columns are not read."""
    found = with_spans(docs, thresholds(docs), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``MASK`` (touching or
    overlapping ones by one) and ``n_chars`` set anew where it exists. Texts without
    spans, null ones included, stay as they are."""
    rows = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    found = with_spans(rows, thresholds(docs), ["__row"])

    def step(acc, s):
        gap = F.substring(F.col("__text"), acc["at"] + 1, s["start"] - acc["at"])
        new = F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(MASK)).alias("out"))
        same = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when((s["start"] > acc["at"]) | (acc["at"] == 0), new).otherwise(same)

    whole = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(F.col("__text"), acc["at"] + 1, F.length("__text"))))
    new = F.when(F.size("spans") > 0, whole)
    cut = found.select("__row", new.alias("__new"))
    cols = {c: F.col("__row")[c] for c in docs.columns}
    cols["text"] = F.coalesce("__new", cols["text"])
    if "n_chars" in cols:
        cols["n_chars"] = F.when(F.col("__new").isNotNull(), F.length("__new").cast(docs.schema["n_chars"].dataType)).otherwise(cols["n_chars"])
    return cut.select(*[c.alias(k) for k, c in cols.items()])
