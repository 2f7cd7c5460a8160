"""Registered queries of the operators and, where SQL can say them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweave.llm import bpe, gru, idstore, langid, manifest, mixing, pages, quality, repeats, setjoin, sharding, topk, trie
from lakeweave.llm.common import reach_workers
from lakeweave.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The same queries as functions of their table.
BUILDS: dict[str, Callable[[DataFrame], DataFrame]] = {}
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def query(table: str, sql: str | None = None):
    """Register a function of one given table under its own name."""

    def add(build: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            reach_workers(spark)
            return build(spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet"))

        QUERIES[build.__name__], BUILDS[build.__name__] = run, build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return add


@query("documents")
def op1_bpe(docs):
    """Every text encoded and decoded; digests of both."""
    texts = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY)
    return texts.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("documents")
def op2_mixing(docs):
    """Half as many words again as there are, by source weights of 3, 1 and 2."""
    return mixing.mix(docs, [3, 1, 2], share=1.5, most_repeats=2)


@query("documents")
def op3_sharding(docs):
    """Forty shards by the id alone."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    return sharding.assign(rows, "doc_id", 40, ("text_crc32", "size"))


@query("documents")
def op10_id_store(docs):
    """Ids written to files, every document read back by its key."""
    spark, folder = docs.sparkSession, scratch_dir(docs.sparkSession, "ids")
    idstore.write_store(docs, folder, VOCABULARY, end_id=2)
    return idstore.fetch(spark, folder, docs.select("doc_id")).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query("embeddings", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS score
           FROM v q, v c WHERE q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 20
""")
def op5_topk(embeddings):
    """The twenty best of all other vectors for each query."""
    vectors = embeddings.select("vec_id", topk.whole_parts(F.col("embedding")).alias("vector"))
    return topk.search(vectors, vectors.filter("vec_id % 20 = 0"), 20)


@query("documents")
def op6_quality(docs):
    """Base rules and thresholds by language and source."""
    return quality.judge(docs)


def fold(doc_id: str, folds: int):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


@query("documents")
def op7_langid(docs):
    """The language of every text, learned from three quarters of the labelled rows."""
    learn = F.coalesce(fold("doc_id", 4) != 2, F.lit(True))
    rows = docs.select("doc_id", "text", "lang")
    return langid.identify(rows, learn).select(
        "doc_id", (~learn).alias("held_out"), "lang_pred", "score")


@query("documents")
def op9_gru(docs):
    """Log probabilities of every text, learned from four fifths of the rows."""
    return gru.score(docs, F.coalesce(fold("doc_id", 5) != 1, F.lit(True)))


@query("documents", """
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS s FROM t),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, root) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id FROM documents d
LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT id, min(root) AS root FROM r GROUP BY 1) m ON m.id = d.doc_id
""")
def op8_setjoin(docs):
    """Groups of documents that share nine tenths of their 3-word shingles."""
    return setjoin.groups(docs)


@query("documents")
def op4_repeats(docs):
    """Passages of a hundred bytes and more that stand earlier in the corpus, cut out."""
    return repeats.remove(docs, length=100).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: CRC-32 of ASCII text as DuckDB can say it, eight shifts a byte.
SQL_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), lambda i: ascii({0}[i])::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""
SQL_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def sql_leaf(text: str) -> str:
    parts = [f"coalesce(octet_length(encode({v}::VARCHAR)) || ':' || {v}, '-')" for v in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


@query("documents", f"""
WITH RECURSIVE d AS (SELECT doc_id, lang, {sql_leaf('text')} AS leaf,
      CASE WHEN {SQL_CRC32.format('(doc_id::VARCHAR)')} % 3 = 0 THEN {sql_leaf(SQL_LOWER.format('text'))} ELSE {sql_leaf('text')} END AS own FROM documents),
a AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
v(lang, l, i, h, n) AS (SELECT lang, 0, i, leaf, n FROM a UNION ALL
      SELECT lang, l + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8) FROM v WHERE n > 1 GROUP BY lang, l, i // 8),
s AS (SELECT lang, h, l AS top, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM v WHERE n = 1),
w(l, i, h, n) AS (SELECT 0, i, h, n FROM s UNION ALL
      SELECT l + 1, i // 8, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 7) // 8) FROM w WHERE n > 1 GROUP BY l, i // 8),
r AS (SELECT h AS root, l AS top FROM w WHERE n = 1),
steps AS (SELECT a.lang, a.i AS leaf_at, unnest(range(0, s.top)) AS l, false AS up FROM a JOIN s ON s.lang IS NOT DISTINCT FROM a.lang
      UNION ALL SELECT s.lang, s.i, unnest(range(0, r.top)), true FROM s, r),
p AS (SELECT t.lang, t.leaf_at, t.up, t.l, coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i < t.leaf_at // (8 ** t.l)::BIGINT), '') AS lo,
      coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i > t.leaf_at // (8 ** t.l)::BIGINT), '') AS hi
      FROM steps t JOIN (SELECT lang, l, i, h, false AS up FROM v UNION ALL SELECT NULL, l, i, h, true FROM w) x
        ON x.up = t.up AND x.l = t.l AND x.i // 8 = t.leaf_at // (8 ** t.l)::BIGINT // 8 AND (t.up OR x.lang IS NOT DISTINCT FROM t.lang)
      GROUP BY t.lang, t.leaf_at, t.up, t.l),
c AS (SELECT a.doc_id, a.leaf, a.own, a.lang, a.i, s.h AS subroot, r.root,
      coalesce((SELECT list({{'lo': lo, 'hi': hi}} ORDER BY l) FROM p WHERE NOT p.up AND p.lang IS NOT DISTINCT FROM a.lang AND p.leaf_at = a.i), [])
      || coalesce((SELECT list({{'lo': lo, 'hi': hi}} ORDER BY l) FROM p WHERE p.up AND p.leaf_at = s.i), []) AS way
      FROM a JOIN s ON s.lang IS NOT DISTINCT FROM a.lang CROSS JOIN r),
f(lang, i, k, h) AS (SELECT lang, i, 0, own FROM c UNION ALL
      SELECT f.lang, f.i, k + 1, sha256(c.way[k + 1].lo || f.h || c.way[k + 1].hi) FROM f JOIN c ON c.lang IS NOT DISTINCT FROM f.lang AND c.i = f.i
      WHERE k < len(c.way))
SELECT c.doc_id, c.leaf, c.subroot, c.root, sha256(list_aggregate(list_transform(c.way, lambda x: x.lo || x.hi) || [''], 'string_agg', '')) AS proof_sha256,
       f.h AS folded_root, f.h = c.root AS verified
FROM c JOIN f ON f.lang IS NOT DISTINCT FROM c.lang AND f.i = c.i AND f.k = len(c.way)
""")
def op12_manifest(docs):
    """A proof for every document, and whether its text, lower-cased in a third of the rows, still leads to the root."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    rows = docs.select("doc_id", "lang", manifest.leaf(*fields).alias("leaf"),
                       F.when(changed, manifest.leaf(*fields[:-1], lowered)).alias("changed"))
    proven = manifest.prove(rows).withColumn("own", F.coalesce("changed", "leaf"))
    folded = manifest.follow(proven, "own", "path", "folded_root", "proof_sha256")
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))


@query("conversations", f"""
WITH t AS (SELECT conv_id AS c, sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS m, turn,
      length(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS w FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, m, w) AS k FROM t),
h AS (SELECT DISTINCT c, {SQL_CRC32.format('(c::VARCHAR)')} % 4 AS h FROM t),
b AS (SELECT h.c, 0 AS own, o.k, o.m, o.w FROM h JOIN o ON o.c = h.c - h.c % 20 AND o.k <= h.h
      UNION ALL SELECT h.c, 1, o.k, o.m, o.w FROM h JOIN o ON o.c = h.c AND o.k > h.h),
s AS (SELECT h.c, coalesce(list(b.m ORDER BY own, k) FILTER (b.m IS NOT NULL), []) AS m, coalesce(list(b.w ORDER BY own, k) FILTER (b.m IS NOT NULL), []) AS w
      FROM h LEFT JOIN b ON b.c = h.c GROUP BY h.c),
e AS (SELECT c, len(m) AS size, w, m, unnest(range(0, len(m) + 1)) AS depth FROM s),
n AS (SELECT array_to_string(m[:depth], '') AS p, depth, min(c) AS conv, count(*) AS n_convs, any_value(CASE WHEN depth > 0 THEN w[depth] END) AS words,
      coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (size = depth), '') AS ends FROM e GROUP BY 1, 2),
u AS (SELECT a.p, count(*) FILTER (x.depth = a.depth + 1) AS n_children, coalesce(sum((x.n_convs - 1) * x.words), 0) AS saved,
      count(*) FILTER (NOT EXISTS (SELECT 1 FROM n y WHERE y.depth = x.depth + 1 AND left(y.p, 64 * x.depth::BIGINT) = x.p)) AS n_leaves
      FROM n a JOIN n x ON x.depth >= a.depth AND left(x.p, 64 * a.depth::BIGINT) = a.p GROUP BY a.p)
SELECT n.conv AS conv_id, n.depth, q.conv AS parent_conv_id, n.n_convs, u.n_children, u.n_leaves, u.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN u ON u.p = n.p LEFT JOIN n q ON n.depth > 0 AND q.depth = n.depth - 1 AND q.p = left(n.p, 64 * (n.depth - 1)::BIGINT)
""")
def op11_trie(conversations):
    """All shared starts of the conversations, each of which begins like the one at the head of its twenty."""
    return trie.trie(trie.shared_starts(trie.conversations(conversations))).drop("key")


@query("pages")
def op13_labeller(pages_):
    """The main text of every page."""
    rows = pages_.select("page_id", "url", "html")
    return pages.extract(rows, pages.fit(rows)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
