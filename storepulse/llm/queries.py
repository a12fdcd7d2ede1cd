"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from storepulse.llm import bpe, decontam, hnsw, langid, license, lmscore, merkle, minhash, packing, rans, tokencount, trie, windows
from storepulse.llm.common import table

VOCABULARY = "byte_bpe_50k.json"


def _vocabulary() -> str:
    return public_tokenizers.path(VOCABULARY)


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_rans_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, written as rANS files in document order, and read back from them."""
    return rans.read_digests(spark, rans.pack_documents(table(spark, sf_dir, "documents"), _vocabulary()))


def op3_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that repeat an earlier document's, as few as cover every repeated word, each with a source and the document's class."""
    found = windows.representatives(windows.duplicate_passages(table(spark, sf_dir, "documents"), every_source=False))
    return found.select("doc_id", "from_word", "to_word", "source_id", "n_sources", "component_id")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file of a tree: its source, then folders of 512 and of 32 ids."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", F.expr("cast(doc_id div 512 as string)"), F.expr("cast(doc_id div 32 as string)"), F.col("doc_id").cast("string"))
    return license.scan(docs.select("doc_id", "text", path.alias("path")))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op7_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of quality 1 against all others, the models matched in size and no document scored by its own counts."""
    return lmscore.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), matched=True, leave_out=True)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), _vocabulary())


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digest(table(spark, sf_dir, "documents"), _vocabulary())


def op11_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text packed into buckets of sequences of equal length, and the pieces' digests read back from them."""
    return packing.digests(packing.read_packed(spark, packing.pack(table(spark, sf_dir, "documents"), _vocabulary())))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, with every second one's newlines lost before it is verified."""
    docs = table(spark, sf_dir, "documents")
    return merkle.verified(merkle.manifest(docs, merkle.without_newlines(docs)))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(*trie.rebuilt(trie.turns_of(table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_hnsw": op1_hnsw,
    "op2_rans_tokens": op2_rans_tokens,
    "op3_compact_windows": op3_compact_windows,
    "op4_language": op4_language,
    "op5_license_scan": op5_license_scan,
    "op6_minhash": op6_minhash,
    "op7_cross_entropy": op7_cross_entropy,
    "op8_decontamination": op8_decontamination,
    "op9_token_counts": op9_token_counts,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_power_of_two_packing": op11_power_of_two_packing,
    "op12_merkle": op12_merkle,
    "op13_prefix_trie": op13_prefix_trie,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Every pair of usable vectors of a label, and the smallest id reachable over links.
_OP1 = """WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS c FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.c = l.a),
comp AS (SELECT a, min(c) AS c FROM reach GROUP BY 1), n AS (SELECT a, count(*) AS n FROM link GROUP BY 1)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, comp.c AS component_id, vec_id = comp.c AS kept
FROM embeddings JOIN comp ON comp.a = vec_id LEFT JOIN n ON n.a = vec_id"""

#: Every pair of documents that share a shingle.
_OP6 = rf"""WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+'), []) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
  ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.c = l.a),
comp AS (SELECT a, min(c) AS c FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, comp.c AS component_id, d.doc_id = comp.c AS kept
FROM documents d JOIN comp ON comp.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id"""

#: Every window of the benchmark against every window of the documents.
_OP8 = rf"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item, least(len(ws), 10) AS k, unnest(list_transform(range(1, greatest(len(ws) - 10, 0) + 2),
  lambda i: array_to_string(ws[i:i + least(len(ws), 10) - 1], ' '))) AS wd FROM b WHERE len(ws) > 0),
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
pos AS (SELECT doc_id, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: {{'i': i, 'wd': array_to_string(ws[i:i + k - 1], ' ')}})) AS x
  FROM d, (SELECT DISTINCT k FROM win) WHERE len(ws) >= k),
occ AS (SELECT doc_id, x.i AS i, pos.k AS k, item FROM pos JOIN win ON win.k = pos.k AND win.wd = x.wd),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, i, k FROM occ)) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN its ON its.doc_id = d.doc_id"""



def _crc32(text: str) -> str:
    """SQL for the CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT), lambda a, b: {bits}), 4294967295)"


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END"


_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))

#: The tree level by level, then every leaf's way up through it.
_OP12 = f"""WITH RECURSIVE d AS (SELECT *, coalesce({_crc32('CAST(doc_id AS VARCHAR)')} % 2 = 0, false) AS hit FROM documents),
f AS (SELECT doc_id, source, sha256({_HEAD} || {_field('text')}) AS leaf, sha256({_HEAD} || {_field("if(hit, replace(text, chr(10), ''), text)")}) AS bad FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM f),
lv AS (SELECT 0 AS lvl, source, idx, leaf AS h, n FROM p
  UNION ALL SELECT lvl + 1, source, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM lv WHERE n > 1 GROUP BY lvl, source, idx // 3, n),
subs AS (SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM lv WHERE n = 1),
rv AS (SELECT 0 AS lvl, idx, h, n FROM subs
  UNION ALL SELECT lvl + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3 FROM rv WHERE n > 1 GROUP BY lvl, idx // 3, n),
runs AS (SELECT lvl, source, idx // 3 AS q, list(h ORDER BY idx) AS hs FROM lv WHERE n > 1 GROUP BY ALL),
tops AS (SELECT lvl, idx // 3 AS q, list(h ORDER BY idx) AS hs FROM rv WHERE n > 1 GROUP BY ALL),
up AS (SELECT doc_id, leaf, source, 0 AS lvl, idx AS place, bad AS h, '' AS proof, row_number() OVER () AS r FROM p
  UNION ALL SELECT doc_id, leaf, up.source, up.lvl + 1, q, sha256(array_to_string(hs[1:place % 3], '') || h || array_to_string(hs[place % 3 + 2:3], '')),
    proof || array_to_string(hs[1:place % 3], '') || array_to_string(hs[place % 3 + 2:3], ''), r
  FROM up JOIN runs ON runs.lvl = up.lvl AND runs.source IS NOT DISTINCT FROM up.source AND runs.q = place // 3),
top AS (SELECT doc_id, leaf, s.h AS subroot, 0 AS lvl, s.idx AS place, u.h AS h, proof, r
  FROM (SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY r ORDER BY lvl DESC) = 1) u JOIN subs s ON s.source IS NOT DISTINCT FROM u.source
  UNION ALL SELECT doc_id, leaf, subroot, top.lvl + 1, q, sha256(array_to_string(hs[1:place % 3], '') || h || array_to_string(hs[place % 3 + 2:3], '')),
    proof || array_to_string(hs[1:place % 3], '') || array_to_string(hs[place % 3 + 2:3], ''), r
  FROM top JOIN tops ON tops.lvl = top.lvl AND tops.q = place // 3)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, h AS folded_root, h = root AS verified
FROM (SELECT * FROM top QUALIFY row_number() OVER (PARTITION BY r ORDER BY lvl DESC) = 1), (SELECT h AS root FROM rv WHERE n = 1)"""

#: Every prefix of every rebuilt conversation, and every node under each of its prefixes.
_OP13 = rf"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, sha256(strlen(role) || ':' || role || text) AS id, len(regexp_extract_all(text, '[^ 	-
]+')) AS words FROM t),
own AS (SELECT conv_id, list({{'id': id, 'words': words}} ORDER BY turn NULLS FIRST, id[:32]) AS turns, {_crc32('CAST(conv_id AS VARCHAR)')} % 4 AS h FROM k GROUP BY conv_id),
c AS (SELECT a.conv_id, coalesce(b.turns[:a.h], []) || coalesce(a.turns[a.h + 1:], []) AS turns FROM own a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
pre AS (SELECT conv_id, len(turns) AS n, unnest(list_transform(range(0, len(turns) + 1), lambda d: {{'d': d, 'p': list_transform(turns[:d], lambda x: x.id), 'w': turns[d].words}})) AS x FROM c),
node AS (SELECT x.p AS p, x.d AS depth, any_value(x.w) AS w, min(conv_id) AS conv_id, count(*) AS n_convs,
  sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = x.d), '')) AS ends_sha256 FROM pre GROUP BY x.p, x.d),
kids AS (SELECT p[:-2] AS p, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
sub AS (SELECT unnest(list_transform(range(0, depth + 1), lambda d: p[:d])) AS p, (n IS NULL)::INT AS leaf, if(depth = 0, 0, (n_convs - 1) * w) AS saved
  FROM node LEFT JOIN kids USING (p)),
total AS (SELECT p, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM sub GROUP BY p)
SELECT node.conv_id, node.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0)::BIGINT AS n_children, n_leaves, saved_tokens, node.ends_sha256
FROM node JOIN total USING (p) LEFT JOIN kids USING (p) LEFT JOIN node up ON node.depth > 0 AND up.p = node.p[:-2]"""

ORACLE_SQL = {"op1_hnsw": _OP1, "op6_minhash": _OP6, "op8_decontamination": _OP8, "op12_merkle": _OP12, "op13_prefix_trie": _OP13}
