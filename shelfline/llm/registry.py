"""One registered query per operator, over its whole table, with the SQL of its result where SQL can state it."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import bands, decontaminate, exact, html_text, langid, minhash, mixing, packing, pivots, repair, suffixes, toolcalls, whitening
from .common import held_out, prepare, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(table(spark, sf_dir, "documents"))


def op4_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.quality_bands(table(spark, sf_dir, "documents"))


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = toolcalls.from_conversations(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame(toolcalls.REPLY, "name string, parameter string, type string, required boolean")
    return toolcalls.link(calls, results, schemas)


def op6_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = os.path.join(scratch_dir(spark), f"tokens-{uuid.uuid4().hex}")
    repair.write(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return repair.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Target weights of the tree's nodes; all others count 1.
WEIGHTS = [("d0", None, None, 4), ("d1", None, None, 3), ("d2", None, None, 2), *((d, "en", None, 3) for d in ("d0", "d1", "d2", "d3"))]


def mixing_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WEIGHTS, "domain string, language string, origin string, weight bigint")


def domain_of() -> Column:
    """Sources fall into four domains by their number."""
    return F.concat(F.lit("d"), (F.regexp_extract("source", "[0-9]+", 0).try_cast("int") % 4).cast("string"))


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), mixing_weights(spark), domain_of())


def op11_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = pivots.compress(table(spark, sf_dir, "embeddings"))
    final = pivots.book_hash(books)
    return coded.select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(final).alias("codebooks_sha256"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.sha2(F.concat_ws(",", F.array_sort("item_ids")), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), names.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


#: DuckDB has no A-Z-only lower(); translate states it. Null counts as empty.
NORMALISED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORDS_12 = f"regexp_extract_all({NORMALISED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def share_sql(name: str, above: str, path: list[str]) -> str:
    """Siblings filled to equal height per weight: the SQL of one level of the tree."""
    group = f"PARTITION BY {', '.join(path[:-1])}" if path[:-1] else ""
    keys = ", ".join(path)
    blank = " AND ".join(f"w.{x} IS NULL" for x in mixing.TREE[len(path) :])
    return f"""
        {name}_height AS (
            SELECT *, (pool - coalesce(sum(capacity) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS height
            FROM (SELECT {', '.join(f'c.{x}' for x in path)}, c.capacity, c.pool, coalesce(w.weight, 1) AS weight
                  FROM ({above}) c LEFT JOIN weights w ON {' AND '.join(f'w.{x} = c.{x}' for x in path)}{' AND ' + blank if blank else ''})
            WHERE weight > 0
            WINDOW o AS ({group} ORDER BY capacity / weight, {path[-1]})),
        {name} AS (
            SELECT {keys}, CASE WHEN capacity <= height * weight THEN capacity ELSE CAST(floor(weight * first_value(CASE WHEN capacity > height * weight THEN height END IGNORE NULLS)
                   OVER ({group} ORDER BY capacity / weight, {path[-1]} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS BIGINT) END AS budget
            FROM {name}_height)"""


def mixing_sql() -> str:
    """The expected selection: budgets by level, then each leaf's prefix by a running sum over the whole leaf."""
    epochs, share, seed = mixing.EPOCHS, mixing.SHARE, mixing.SEED
    value = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    weights = ", ".join(f"({', '.join(map(value, row))})" for row in WEIGHTS)
    first, second, leaf = (mixing.TREE[: n + 1] for n in range(3))
    level = lambda path, parent: f"SELECT {', '.join(path)}, sum(capacity) AS capacity, any_value(b.budget) AS pool FROM leaves JOIN {parent} b USING ({', '.join(path[:-1])}) GROUP BY {', '.join(path)}"
    return f"""
        WITH weights(domain, language, origin, weight) AS (VALUES {weights}),
        rows AS (
            SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
                   coalesce('d' || (TRY_CAST(regexp_extract(source, '[0-9]+') AS INTEGER) % 4), '{mixing.NONE}') AS domain,
                   coalesce(lang, '{mixing.NONE}') AS language, coalesce(source, '{mixing.NONE}') AS origin
            FROM documents),
        leaves AS (SELECT {', '.join(leaf)}, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) AS BIGINT) * {epochs} AS capacity FROM rows WHERE n_tokens > 0 GROUP BY {', '.join(leaf)}),
        {share_sql('top', f"SELECT domain, sum(capacity) AS capacity, (SELECT floor(sum(tokens) * CAST({share} AS DOUBLE)) FROM leaves) AS pool FROM leaves GROUP BY domain", first)},
        {share_sql('middle', level(second, 'top'), second)},
        {share_sql('bottom', level(leaf, 'middle'), leaf)},
        chosen AS (
            SELECT r.*, CAST(floor(budget / tokens) AS BIGINT) AS passes, budget, tokens,
                   md5('{seed}:' || CAST(floor(budget / tokens) AS BIGINT) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
            FROM rows r JOIN bottom USING ({', '.join(leaf)}) JOIN leaves USING ({', '.join(leaf)}) WHERE n_tokens > 0),
        counted AS (
            SELECT *, passes + CASE WHEN sum(n_tokens) OVER (PARTITION BY {', '.join(leaf)} ORDER BY place RANGE UNBOUNDED PRECEDING) <= budget - passes * tokens THEN 1 ELSE 0 END AS copies
            FROM chosen)
        SELECT doc_id, {', '.join(leaf)}, unnest(range(CAST(copies AS BIGINT))) AS epoch, n_tokens FROM counted"""


def lloyd_assign(n: int) -> str:
    """The entry nearest to each part (table near<n>) under the codebook of a round; of equal distances the first."""
    return f"""near{n} AS (
            SELECT r, part, arg_min(entry, d * {pivots.ENTRIES} + entry) AS entry, min(d) AS d
            FROM (SELECT r, part, entry, sum((x.v - b.v) * (x.v - b.v)) AS d FROM x JOIN book{n} b USING (part, pos) GROUP BY r, part, entry) GROUP BY r, part)"""


SQL = {
    "op3_exact_dedup": f"""
        WITH rows AS (SELECT doc_id, {NORMALISED} AS content FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
        FROM rows WINDOW same AS (PARTITION BY content)
    """,
    "op5_tool_calls": """
        WITH RECURSIVE calls AS (
            SELECT conv_id, turn, conv_id || '-' || turn AS call_id, min(text) AS text, count(*) AS copies,
                   json_object('n_chars', coalesce(length(min(text)), 0), 'prompt', min(text)) AS arguments
            FROM conversations WHERE role = 'user' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn),
        answers AS (
            SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, min(text) AS content, count(*) AS copies
            FROM conversations WHERE role = 'assistant' AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn),
        depth AS (
            SELECT c.conv_id, c.turn, c.call_id, 0 AS level FROM calls c
            WHERE NOT EXISTS (FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
            UNION ALL
            SELECT c.conv_id, c.turn, c.call_id, d.level + 1 FROM calls c JOIN depth d ON c.conv_id = d.conv_id AND c.turn = d.turn + 2)
        SELECT coalesce(c.conv_id, a.conv_id) AS conv_id, coalesce(c.call_id, a.call_id) AS call_id, d.level AS level,
               CASE WHEN c.call_id IS NULL THEN 'result without a call'
                    WHEN c.turn >= 2 AND d.level = 0 THEN 'unknown call referred to'
                    WHEN c.text IS NULL THEN 'wrong argument type'
                    WHEN a.call_id IS NULL THEN 'no result' ELSE 'ok' END AS status,
               coalesce(c.copies, a.copies) AS copies,
               CAST(json_object('arguments', c.arguments, 'call_id', coalesce(c.call_id, a.call_id),
                                'name', CASE WHEN c.call_id IS NOT NULL THEN 'reply' END, 'result', a.content) AS VARCHAR) AS record
        FROM calls c FULL JOIN answers a ON c.conv_id = a.conv_id AND c.call_id = a.call_id
        LEFT JOIN depth d ON d.call_id = c.call_id
    """,
    "op8_minhash": f"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex({NORMALISED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
        shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(other) AS component_id, s.doc_id = min(other) AS kept
        FROM sets s JOIN reach USING (doc_id) GROUP BY s.doc_id, len(s.s)
    """,
    "op10_mix": mixing_sql(),
    "op11_pivots": f"""
        WITH rows AS (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, * FROM embeddings
            WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
        x AS (SELECT r, (i - 1) // (n // {pivots.PARTS}) AS part, (i - 1) % (n // {pivots.PARTS}) AS pos, CAST(floor({pivots.SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v
              FROM (SELECT *, len(embedding) AS n, unnest(range(1, len(embedding) + 1)) AS i FROM rows)),
        book0 AS (SELECT part, r - 1 AS entry, pos, v FROM x WHERE r <= {pivots.ENTRIES}),
        {', '.join(f"""{lloyd_assign(n)},
        book{n + 1} AS (
            SELECT part, entry, pos, coalesce(mean, b.v) AS v
            FROM book{n} b LEFT JOIN (SELECT part, entry, pos, CAST(floor(sum(v) / count(*)) AS BIGINT) AS mean FROM near{n} JOIN x USING (r, part) GROUP BY ALL) USING (part, entry, pos))"""
            for n in range(pivots.ROUNDS))},
        {lloyd_assign(pivots.ROUNDS)},
        codes AS (SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near{pivots.ROUNDS} GROUP BY r)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(v, ',' ORDER BY part, entry, pos)) FROM book{pivots.ROUNDS}) AS codebooks_sha256
        FROM rows JOIN codes USING (r)
    """,
    "op12_decontaminate": f"""
        WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, {WORDS_12} AS w FROM documents),
        items AS (SELECT item_id, {WORDS_12} AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS x
            FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
        places AS (
            SELECT row_no, k, i, array_to_string(w[i:i + k - 1], ' ') AS x
            FROM (SELECT row_no, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
        met AS (SELECT row_no, p.k, i, item_id FROM places p JOIN windows v ON p.x = v.x AND p.k = v.k),
        hits AS (SELECT row_no, count(DISTINCT j) AS n_hit FROM (SELECT row_no, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT row_no, k, i FROM met)) GROUP BY row_no),
        named AS (SELECT row_no, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT row_no, CAST(item_id AS VARCHAR) AS name FROM met WHERE item_id IS NOT NULL) GROUP BY row_no)
        SELECT doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (row_no) LEFT JOIN named USING (row_no)
    """,
}

QUERIES = [op1_html_text, op2_pack, op3_exact_dedup, op4_compression_bands, op5_tool_calls, op6_repair, op7_language, op8_minhash, op9_suffixes, op10_mix, op11_pivots, op12_decontaminate, op13_whiten]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def prepared(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(prepare(spark), sf_dir)

    return {query.__name__: prepared(query) for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
