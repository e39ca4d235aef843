"""Secret scans: fixed patterns plus a randomness test battery.

Three patterns give the base spans. Besides, every long run of code-like characters is a
candidate: its encoding is inferred, and three tests ask whether it looks drawn at random
from that encoding's alphabet: chi-squared uniformity (Wilson-Hilferty), the runs test
about the alphabet's middle, and lag-1 serial correlation. Fisher's method joins their
p-values. Benjamini-Hochberg, within each encoding and length band (longer strings give
the tests more power, so lengths do not share a threshold), decides which candidates are
rejected as not random; the others become spans of kind ``random``.

All of it is Spark SQL expressions. The corpus-wide step is a histogram of p-values per
encoding and band, on a logarithmic scale (at most 4 x 64 strata of some 30,000 bins), so that
small p-values stay apart however many candidates there are.

Defined cases: null counts as empty and has no spans; positions are code points, end
exclusive; every input row gives one row, repeated ids included; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finpanel.llm.common import land, run_dir

# The three base patterns, the shortest group or match that counts, their order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")
#: Candidates of the battery: at least this many characters, with a digit and a letter among them.
CANDIDATE_MIN = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}" % CANDIDATE_MIN
ALPHABETS = {"hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
             "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
             "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
#: Bins of p-values per factor of two.
OCTAVE = 256


#: Matches that one fold appends to its list; a text's folds are joined by their offsets.
FOLD = 256


def _once(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def found(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches: array of (s, e, m), code points, e exclusive."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0)
    kind = "array<struct<s:int,e:int,m:string>>"
    none = F.array().cast(kind)
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc, x):
        s = acc["at"] + F.length(x["gap"])
        e = s + F.length(x["m"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    def folds(pairs):
        last = F.floor((F.size(pairs) - 1) / FOLD).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.aggregate(F.slice(pairs, k * FOLD + 1, F.lit(FOLD)), start, step))

    def joined(parts):
        offsets = F.aggregate(parts, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["at"])))
        return F.flatten(F.zip_with(parts, F.slice(offsets, F.lit(1), F.size(parts)), lambda part, off: F.transform(
            part["out"], lambda x: F.struct((x["s"] + off).alias("s"), (x["e"] + off).alias("e"), x["m"].alias("m")))))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, m: F.struct(g.alias("gap"), m.alias("m")))
    return F.when(F.rlike(text, F.lit(pattern)), _once(pairs, lambda p: _once(folds(p), joined))).otherwise(none)


def _upper_tail(z: Column) -> Column:
    """1 - Phi(z), by the logistic approximation with a cubic term (error below 2e-4)."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(F.lit(600.0), z * 1.5976 + z * z * z * 0.070565992)))


def battery(s: Column) -> Column:
    """struct(encoding, band, p): Fisher's combined p-value of the three tests for a string."""
    enc = (F.when(s.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(s.rlike("^[A-Z2-7]+$"), "base32")
           .when(s.rlike("^[A-Za-z0-9]+$"), "alnum").otherwise("base64"))
    alphabet = F.element_at(F.create_map(*[F.lit(x) for kv in ALPHABETS.items() for x in kv]), enc)
    body = F.when(enc == "hex", F.lower(s)).otherwise(F.translate(s, "-_", "+/"))
    # Each helper column lives in a one-element array, so that it is computed once and named.
    v = F.transform(F.filter(F.split(body, ""), lambda c: c != ""),
                    lambda c: F.call_function("instr", alphabet, c).cast("double"))

    def tests(v: Column) -> Column:
        n, m = F.size(v).cast("double"), F.length(alphabet).cast("double")
        zero = F.lit(0.0)
        squares = F.aggregate(F.array_distinct(v), zero, lambda a, x: a + F.pow(F.size(F.filter(v, lambda y: y == x)), F.lit(2)))
        chi, df = m / n * squares - n, m - 1
        z1 = (F.cbrt(F.greatest(chi, zero) / df) - (F.lit(1.0) - F.lit(2.0) / (df * 9))) / F.sqrt(F.lit(2.0) / (df * 9))
        nxt = F.slice(v, F.lit(2), F.size(v) - 1)
        prv = F.slice(v, F.lit(1), F.size(v) - 1)
        mid = (m + 1) / 2
        high = F.size(F.filter(v, lambda x: x > mid)).cast("double")
        changes = F.aggregate(F.zip_with(prv, nxt, lambda a, b: ((a > mid) != (b > mid)).cast("double")), zero, lambda a, x: a + x)
        mean = high * (n - high) * 2 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        p2 = F.when(var > 0, _upper_tail(F.abs(changes + 1 - mean) / F.sqrt(var)) * 2).otherwise(zero)
        avg = F.aggregate(v, zero, lambda a, x: a + x) / n
        spread = F.aggregate(v, zero, lambda a, x: a + (x - avg) * (x - avg))
        lag = F.aggregate(F.zip_with(prv, nxt, lambda a, b: (a - avg) * (b - avg)), zero, lambda a, x: a + x)
        p3 = F.when(spread > 0, _upper_tail(F.abs(lag / spread + F.lit(1.0) / n) * F.sqrt(n)) * 2).otherwise(zero)
        half = zero
        for p in (_upper_tail(z1), p2, p3):
            half = half - F.log(F.least(F.lit(1.0), F.greatest(F.lit(1e-12), p)))
        return F.exp(-half) * (half * half / 2 + half + 1)

    return F.struct(enc.alias("encoding"), F.floor(F.log2(F.length(s))).cast("int").alias("band"),
                    F.get(F.transform(F.array(v), tests), F.lit(0)).alias("p"))


def _bin(p: Column) -> Column:
    """Place of a p-value on a logarithmic scale: bins a factor of 2 ** (1 / OCTAVE) wide, 0 at p = 1."""
    return F.floor(F.log2(F.greatest(p, F.lit(1e-300))) * -OCTAVE).cast("int")


def thresholds(tested: DataFrame, alpha: float) -> dict[str, int]:
    """Benjamini-Hochberg on the logarithmic scale: stratum -> first bin that is rejected, and with it all
    smaller p-values (strata without one are left out)."""
    hist = (tested.select(F.concat_ws("/", "encoding", "band").alias("stratum"), _bin(F.col("p")).alias("bin"))
            .groupBy("stratum", "bin").agg(F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy("stratum").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = hist.withColumn("k", F.sum("n").over(upto)).withColumn("m", F.sum("n").over(Window.partitionBy("stratum")))
    passed = ranked.where(F.pow(F.lit(2.0), -F.col("bin") / OCTAVE) <= F.col("k") * alpha / F.col("m"))
    return {r["stratum"]: r["bin"] for r in passed.groupBy("stratum").agg(F.min("bin").alias("bin")).collect()}


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.05) -> DataFrame:
    """One row per input row: id, spans: array of (s, rank, e, kind), ordered; rank 3 is the battery's."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    group = F.regexp_extract
    base = F.concat(
        F.transform(F.filter(found(text, ASSIGN), lambda x: F.length(group(x["m"], ASSIGN, 2)) >= ASSIGN_MIN),
                    lambda x: F.struct(x["s"].alias("s"), F.lit(0).alias("rank"), x["e"].alias("e"))),
        # A longest run of the class is one match, so the minimum length may stand in the pattern.
        F.transform(found(text, ACCESS[:-1] + "{%d,}" % (ACCESS_MIN - 4)), lambda x: F.struct(x["s"].alias("s"), F.lit(1).alias("rank"), x["e"].alias("e"))),
        F.transform(found(text, HEX[:-1] + "{%d,}" % HEX_MIN), lambda x: F.struct(x["s"].alias("s"), F.lit(2).alias("rank"), x["e"].alias("e"))))
    mixed = F.filter(found(text, CANDIDATE), lambda x: x["m"].rlike("[0-9]") & x["m"].rlike("[A-Za-z]"))
    rows = docs.select(F.col(id_col).alias("id"), base.alias("base"), mixed.alias("runs"))
    free = F.filter("runs", lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    rows = rows.select("id", "base", F.transform(free, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), battery(x["m"]).alias("t"))).alias("runs"))
    rows = land(rows, f"{run_dir(docs.sparkSession, 'secrets')}/rows")
    cut = thresholds(rows.select(F.explode("runs").alias("x")).select("x.t.*"), alpha)
    # A map with one entry that no stratum has stands for "nothing rejected".
    first = F.create_map(*[F.lit(x) for kv in sorted((cut | {"": 0}).items()) for x in kv])
    rejected = lambda t: _bin(t["p"]) >= F.coalesce(F.try_element_at(first, F.concat_ws("/", t["encoding"], t["band"])), F.lit(1 << 30))
    flagged = F.filter("runs", lambda x: ~rejected(x["t"]))
    extra = F.transform(flagged, lambda x: F.struct(x["s"].alias("s"), F.lit(3).alias("rank"), x["e"].alias("e")))
    return rows.select("id", F.array_sort(F.concat("base", extra)).alias("spans"))


def shown(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["rank"]), x["s"], x["e"])), ",")
