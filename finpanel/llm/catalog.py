"""The opN_<name> queries over the driver tables, and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finpanel.llm import (context_mixing, decontaminate, exact_dedup, line_dedup, merkle, mixing, packing, partenum, ranked_search,
                          recompression, secrets, suffix_dedup, zstd_langid)
from finpanel.llm.common import docs_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


@query("op1_exact_dedup", r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h)
""")
def op1(spark, sf_dir):
    out = exact_dedup.exact_dedup(docs_table(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                      F.lower(F.hex("digest")).alias("text_sha256"))


#: The tree of the mix: domains by the number in the source's name, then language, then source.
DOMAINS = ("web", "books", "code")
MIX_WEIGHTS = [{"web": 50, "books": 30, "code": 20}, {"en": 50, "de": 20, "fr": 15, "es": 15}, {}]
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 4, 42


def mix_levels(docs):
    number = F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 3")
    return {"domain": F.get(F.array(*[F.lit(d) for d in DOMAINS]), number), "language": F.col("lang"),
            "origin": F.col("source")}


_MIX_STEP = """
{name}_n AS (SELECT {keys}, sum(cap)::BIGINT AS cap, any_value(w{k}) AS w FROM leaf GROUP BY {keys}),
{name}_b AS (SELECT n.*, p.budget FROM {name}_n n {join}),
{name}_l AS (SELECT *, (budget - coalesce(sum(cap) OVER (PARTITION BY {part} ORDER BY cap / w, {node} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
   / (sum(w) OVER (PARTITION BY {part} ORDER BY cap / w, {node} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS lam FROM {name}_b),
{name} AS (SELECT {keys}, floor(least(cap::DOUBLE, w * max(lam) OVER (PARTITION BY {part})))::BIGINT AS budget FROM {name}_l),
"""


@query("op4_mixing", r"""
WITH doc AS (
  SELECT doc_id, CASE try_cast(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' WHEN 2 THEN 'code' ELSE '(none)' END AS domain,
         coalesce(lang, '(none)') AS language, coalesce(source, '(none)') AS origin,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
  FROM documents),
live AS (SELECT * FROM doc WHERE n_tokens > 0),
leaf AS (SELECT domain, language, origin, sum(n_tokens)::BIGINT AS tokens, count(*) AS rows, sum(n_tokens)::BIGINT * 4 AS cap,
  CASE domain WHEN 'web' THEN 50 WHEN 'books' THEN 30 WHEN 'code' THEN 20 ELSE 1 END AS w0,
  CASE language WHEN 'en' THEN 50 WHEN 'de' THEN 20 WHEN 'fr' THEN 15 WHEN 'es' THEN 15 ELSE 1 END AS w1, 1 AS w2
  FROM live GROUP BY ALL),
total AS (SELECT floor(sum(tokens) * 0.5)::BIGINT AS budget FROM leaf),
""" + _MIX_STEP.format(name="dom", k=0, keys="domain", node="domain", part="1", join="CROSS JOIN total p")
       + _MIX_STEP.format(name="lan", k=1, keys="domain, language", node="language", part="domain", join="JOIN dom p USING (domain)")
       + _MIX_STEP.format(name="ori", k=2, keys="domain, language, origin", node="origin", part="domain, language",
                          join="JOIN lan p USING (domain, language)") + r"""
plan AS (SELECT l.*, b.budget AS alloc, floor(b.budget / l.tokens)::BIGINT AS epochs FROM leaf l JOIN ori b USING (domain, language, origin)),
ordered AS (SELECT d.*, p.epochs, p.alloc - p.epochs * p.tokens AS rest,
  sum(n_tokens) OVER (PARTITION BY domain, language, origin ORDER BY md5('42:' || p.epochs || ':' || doc_id), doc_id) AS upto
  FROM live d JOIN plan p USING (domain, language, origin))
SELECT doc_id, domain, language, origin, n_tokens, epochs + (upto <= rest)::BIGINT AS copies
FROM ordered WHERE epochs + (upto <= rest)::BIGINT > 0
""")
def op4(spark, sf_dir):
    docs = docs_table(spark, sf_dir)
    out = mixing.mix(docs, mix_levels(docs), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return out.withColumnRenamed("id", "doc_id").drop("d", "r")


@query("op7_line_dedup", r"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, p, l[p] || chr(10) || l[p + 1] || chr(10) || l[p + 2] AS g
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM l WHERE len(l) >= 3)
      WHERE trim(l[p] || l[p + 1] || l[p + 2]) <> ''),
later AS (SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM later, (SELECT unnest([0, 1, 2]) AS k)),
kept AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY p) AS t, count(*) AS n FROM
  (SELECT doc_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS p FROM l WHERE text IS NOT NULL)
  ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT l.doc_id, coalesce(len(l.l), 0)::BIGINT AS n_lines, (coalesce(len(l.l), 0) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM l LEFT JOIN kept k USING (doc_id)
""")
def op7(spark, sf_dir):
    out = line_dedup.line_dedup(docs_table(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_removed",
                      F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op9_secrets")
def op9(spark, sf_dir):
    out = secrets.secret_spans(docs_table(spark, sf_dir))
    base = F.filter("spans", lambda x: x["rank"] < 3)

    def many(rank):  # the lambda takes one argument: Spark would fill a second one with the element's place
        return F.size(F.filter("spans", lambda x: x["rank"] == rank)).cast("long")

    return out.select(F.col("id").alias("doc_id"), many(0).alias("n_assign"), many(1).alias("n_access"), many(2).alias("n_hex"),
                      F.sha2(secrets.shown(base).cast("binary"), 256).alias("base_sha256"),
                      secrets.shown(F.col("spans")).alias("spans"))


@query("op3_substring_dedup", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents),
g AS (SELECT doc_id, p, array_to_string(l[p:p + 49], ' ') AS g
      FROM (SELECT doc_id, l, unnest(range(1, len(l) - 48)) AS p FROM w WHERE len(l) >= 50)),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS least FROM g),
  (SELECT unnest(range(0, 50)) AS k) WHERE doc_id > least),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n
  FROM (SELECT doc_id, unnest(l) AS x, unnest(range(1, len(l) + 1)) AS p FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(w.l)::BIGINT AS n_words, (len(w.l) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM w LEFT JOIN kept k USING (doc_id)
""")
def op3(spark, sf_dir):
    out = recompression.substring_dedup(docs_table(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_suffix_dedup", r"""
WITH w AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
g AS (SELECT doc_id, p, substr(x, 2 * p + 1, 100) AS g
      FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS p FROM w WHERE len(x) >= 100)),
hit AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY g) AS least FROM g) WHERE doc_id > least),
run AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM
  (SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM
   (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS fresh FROM hit)) GROUP BY doc_id, k),
part AS (SELECT doc_id, a AS till, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS since FROM run
  UNION ALL SELECT w.doc_id, len(x) // 2, coalesce(max(b), 0) FROM w LEFT JOIN run USING (doc_id) GROUP BY w.doc_id, x),
kept AS (SELECT doc_id, string_agg(substr(x, 2 * since + 1, 2 * (till - since)), '' ORDER BY since) AS t FROM part JOIN w USING (doc_id) GROUP BY doc_id)
SELECT w.doc_id, (len(x) // 2)::BIGINT AS n_bytes, ((len(x) - len(t)) // 2)::BIGINT AS n_removed,
       (SELECT count(*) FROM run r WHERE r.doc_id = w.doc_id) AS n_spans, sha256(unhex(t)) AS kept_sha256
FROM w JOIN kept USING (doc_id)
""")
def op5(spark, sf_dir):
    out = suffix_dedup.suffix_dedup(docs_table(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op8_ngram_jaccard", r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(l[p:p + 4], ' ') AS s
      FROM (SELECT doc_id, l, unnest(range(1, greatest(len(l) - 4, 1) + 1)) AS p FROM w WHERE len(l) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT link.b, reach.c FROM reach JOIN link ON link.a = reach.doc_id WHERE reach.c < link.b)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reach.c) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach USING (doc_id) GROUP BY w.doc_id
""")
def op8(spark, sf_dir):
    out = partenum.near_groups(docs_table(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


@query("op6_lm_scoring")
def op6(spark, sf_dir):
    return context_mixing.lm_scores(docs_table(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query("op10_language_id")
def op10(spark, sf_dir):
    docs = docs_table(spark, sf_dir)
    out_of_fold = zstd_langid.held_out(F.col("doc_id"), 4, 2)
    found = zstd_langid.identify(docs.select("doc_id", "text"), docs.where(~out_of_fold))
    return found.select("doc_id", out_of_fold.alias("held_out"), F.col("language.lang").alias("lang_pred"),
                        F.col("language.score").alias("score"), F.col("language.rejected").alias("rejected"))


@query("op2_decontaminate")
def op2(spark, sf_dir):
    out = decontaminate.leaks(docs_table(spark, sf_dir), docs_table(spark, sf_dir, "benchmark"))
    return out.select(F.col("id").alias("doc_id"), F.col("item").cast("long").alias("item_id"), "score", "question_overlap", "answer_overlap")


@query("op11_ranked_search", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS l FROM documents),
q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT count(*) FILTER (len(l) > 0) AS n, sum(len(l))::BIGINT AS len FROM d),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(l) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(s.n) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM t, s GROUP BY term),
m AS (SELECT doc_id, 75 + (25 * len(l)::BIGINT * s.n) // s.len AS m FROM d, s WHERE s.len > 0),
r AS (SELECT item_id, doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM t JOIN q USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM
  (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r WHERE score > 0) WHERE rank <= 20
""")
def op11(spark, sf_dir):
    out = ranked_search.search(docs_table(spark, sf_dir), docs_table(spark, sf_dir, "benchmark"), 20)
    return out.withColumnRenamed("id", "doc_id")


@query("op12_packing")
def op12(spark, sf_dir):
    import public_tokenizers
    return packing.pack(docs_table(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end=1)


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
_UP = "UNION ALL SELECT {tree}, lvl + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(h, '' ORDER BY idx)) FROM {name} WHERE n > 1 GROUP BY tree, lvl, idx // 8"


@query("op13_merkle_manifest", r"""
WITH RECURSIVE c AS (SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 3 = 0 AS hit
  FROM documents),
a AS (SELECT *, CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS altered FROM c),
b AS (SELECT doc_id, lang, """ + _LEAF.format(text="text") + " AS h, " + _LEAF.format(text="altered") + r""" AS x FROM a),
leaf AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, h) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM b),
up(tree, lvl, idx, n, h) AS (SELECT tree, 0, idx, n, h FROM leaf """ + _UP.format(tree="tree", name="up") + r"""),
top(tree, lvl, idx, n, h) AS (SELECT -1, 0, tree, (SELECT count(*) FROM up WHERE n = 1), h FROM up WHERE n = 1 """ + _UP.format(tree="tree", name="top") + r"""),
node AS (SELECT * FROM up WHERE n > 1 UNION ALL SELECT * FROM top WHERE n > 1),
sib AS (SELECT p.tree, p.lvl, p.idx, coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < p.idx), '') AS bef, coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > p.idx), '') AS aft
  FROM node p LEFT JOIN node s ON s.tree = p.tree AND s.lvl = p.lvl AND s.idx // 8 = p.idx // 8 AND s.idx <> p.idx GROUP BY ALL),
low(doc_id, leaf, own, tree, lvl, idx, n, acc, sibs) AS (SELECT doc_id, h, idx, tree, 0, idx, n, x, '' FROM leaf
  UNION ALL SELECT doc_id, leaf, own, tree, lvl + 1, idx // 8, (n + 7) // 8, sha256(bef || acc || aft), sibs || bef || aft FROM low JOIN sib USING (tree, lvl, idx) WHERE n > 1),
high(doc_id, leaf, own, start, tree, lvl, idx, n, acc, sibs) AS (SELECT doc_id, leaf, own, tree, -1, 0, tree, (SELECT count(*) FROM up WHERE n = 1), acc, sibs FROM low WHERE n = 1
  UNION ALL SELECT doc_id, leaf, own, start, tree, lvl + 1, idx // 8, (n + 7) // 8, sha256(bef || acc || aft), sibs || bef || aft FROM high JOIN sib USING (tree, lvl, idx) WHERE n > 1)
SELECT high.doc_id, high.leaf, up.h AS subroot, top.h AS root, sha256(sibs) AS proof_sha256, acc AS folded_root, acc = top.h AS verified
FROM high JOIN up ON up.tree = high.start AND up.n = 1 JOIN top ON top.n = 1 WHERE high.n = 1
""")
def op13(spark, sf_dir):
    docs = docs_table(spark, sf_dir)
    m = merkle.manifest(docs, carry={"altered": merkle.tampered(docs)})
    return merkle.check_proofs(m, "altered").select(
        "doc_id", merkle.hex_text(F.col("leaf")).alias("leaf"), merkle.hex_text(F.col("subroot")).alias("subroot"), "root",
        merkle.siblings_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")
