"""Queries over the operators of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import byte_contexts, factorisation, lattice, min_max, packing, part_trie, phrase_index, rule_forest, separator_scan, simhash, surrogates, term_pipeline, url_rules
from starloom.llm.words import fold, table
from starloom.session import scratch_path, written_once

QUALITY_THRESHOLD = 0.3
END_OF_TEXT = 49407
PIECE_END = 1


def tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_separator_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Writes ``documents`` as flat token files, which then know nothing of documents, and scans them."""
    files = scratch_path(spark, "token-files")
    separator_scan.write_token_files(table(spark, sf, "documents"), files, tokenizer(), END_OF_TEXT)
    found = separator_scan.document_lengths(spark, files, END_OF_TEXT)
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("file")
    return found.select(number, "document", "start", "n_tokens", "terminated")


def surrogate_key(spark: SparkSession) -> str:
    """The secret that surrogates are drawn with; who has it can test guesses of an entity."""
    return spark.conf.get("spark.starloom.surrogate.key", "not a secret")


def op2_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return surrogates.surrogates_for(docs, surrogate_key(spark), count_as="n_replaced")


def op3_subword_lattice(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").withColumn("train", fold() != 1)
    scored = lattice.score(docs, public_tokenizers.path("piece_bpe_32k.model"))
    held_out = (~F.col("train")).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_association_rules(spark: SparkSession, sf: str) -> DataFrame:
    """The label of a page is the quality of the document of the same id."""
    labels = rule_forest.clean_labels(table(spark, sf, "labels")).withColumnRenamed("doc_id", "page_id")
    judged = url_rules.judge(table(spark, sf, "pages").select("page_id", "url"), labels)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_swap_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf, "documents"), tokenizer(), PIECE_END)
    digested = written_once(pieces.withColumn("ids", F.crc32("ids")).withColumnRenamed("ids", "ids_crc32"), "pieces")
    return packing.pack(digested)


def op6_language_contexts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    trees = byte_contexts.learn(docs.where(fold() != 0))
    return byte_contexts.predict(docs, trees).select(
        "doc_id", (fold() == 0).alias("held_out"), "lang_pred", "score"
    )


def op7_rule_forest(spark: SparkSession, sf: str) -> DataFrame:
    counted = rule_forest.rule_statistics(table(spark, sf, "documents"))
    statistics = written_once(counted, "rule-statistics")
    judged = rule_forest.judge(statistics, table(spark, sf, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "anomaly",
    )


def op8_pigeonring(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


def op9_positional_index(spark: SparkSession, sf: str) -> DataFrame:
    judged = phrase_index.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), proximity=True)
    digest = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return judged.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated", "n_near")


def op10_factorisation_machine(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    labelled = rule_forest.clean_labels(table(spark, sf, "labels")).where(fold() != 0)
    model = factorisation.train(docs, labelled, ["n_chars"])
    return factorisation.score(docs, model, ["n_chars"]).select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op11_part_trie(spark: SparkSession, sf: str) -> DataFrame:
    found = part_trie.compressed(table(spark, sf, "embeddings"))
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_min_max(spark: SparkSession, sf: str) -> DataFrame:
    return min_max.near_copies(table(spark, sf, "documents"))


def op13_term_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return term_pipeline.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_separator_scan, op2_surrogates, op3_subword_lattice, op4_association_rules, op5_swap_packing, op6_language_contexts, op7_rule_forest, op8_pigeonring, op9_positional_index, op10_factorisation_machine, op11_part_trie, op12_min_max, op13_term_pipeline]
    return {query.__name__: query for query in found}


def oracle_sql() -> dict[str, str]:
    words = """list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"""
    terms = words.replace("\\x3A-\\x60", "\\x3A-\\x40\\x5B-\\x60")
    return {
        "op11_part_trie": codes_sql(),
        "op12_min_max": f"""WITH RECURSIVE
            said AS (
              SELECT doc_id, {words.replace("\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F", "\\x20\\x09-\\x0D")} AS w
              FROM documents),
            sets AS MATERIALIZED (
              SELECT DISTINCT doc_id, array_to_string(w[s : s + 2], ' ') AS shingle
              FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS s FROM said WHERE len(w) > 0)),
            sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
            common AS (
              SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
              FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
            links AS MATERIALIZED (
              SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
              WHERE 100 * c >= 85 * (x.n + y.n - c)),
            reach AS (
              SELECT doc_id AS node, doc_id AS other FROM documents
              UNION SELECT node, b FROM reach JOIN links ON other = a),
            named AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
            SELECT said.doc_id, coalesce(n, 0) AS n_shingles, component_id, said.doc_id = component_id AS kept
            FROM said LEFT JOIN sizes USING (doc_id) JOIN named ON node = said.doc_id""",
        "op13_term_pipeline": f"""WITH
            said AS (
              SELECT row_number() OVER () AS row_id, doc_id, {terms} AS t FROM documents),
            totals AS (
              SELECT count(*) FILTER (len(t) > 0) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM said),
            asked AS (SELECT DISTINCT item_id, unnest({terms}) AS term FROM benchmark),
            held AS (
              SELECT row_id, doc_id, n, term, count(*) AS tf
              FROM (SELECT row_id, doc_id, len(t) AS n, unnest(t) AS term FROM said)
              WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
            weights AS (
              SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
              FROM held, totals GROUP BY term, n_docs),
            scored AS (
              SELECT item_id, row_id, doc_id, CAST(sum(w * ((1000000000 * tf)
                     // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
              FROM asked JOIN held USING (term) JOIN weights USING (term), totals GROUP BY ALL)
            SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score
            FROM scored WHERE score > 0
            WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY rank <= 10""",
        "op9_positional_index": f"""WITH
            items AS (SELECT item_id, {words} AS w FROM benchmark),
            sized AS (SELECT item_id, w, least(13, len(w)) AS k FROM items WHERE len(w) > 0),
            windows AS (
              SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS phrase,
                     array_to_string(list_sort(w[s : s + k - 1]), ' ') AS bag
              FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS s FROM sized)),
            said AS (SELECT doc_id, {words} AS w FROM documents),
            places AS (
              SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS phrase,
                     array_to_string(list_sort(w[s : s + k - 1]), ' ') AS bag
              FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
                    FROM said CROSS JOIN (SELECT DISTINCT k FROM sized))),
            matches AS (SELECT doc_id, s, k, item_id FROM places JOIN windows USING (k, phrase)),
            near AS (
              SELECT doc_id, count(DISTINCT item_id) AS n_near FROM places JOIN windows USING (k, bag) GROUP BY doc_id),
            hits AS (
              SELECT doc_id, count(DISTINCT place) AS n_hit
              FROM (SELECT doc_id, unnest(range(s, s + k)) AS place FROM matches) GROUP BY doc_id),
            listed AS (
              SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
              FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM matches)
              WHERE item_id IS NOT NULL GROUP BY doc_id)
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
                   coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
                   coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
                   coalesce(n_near, 0) AS n_near
            FROM said LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
            LEFT JOIN near USING (doc_id)""",
    }


def codes_sql(n_parts: int = part_trie.PARTS, n_entries: int = part_trie.ENTRIES, rounds: int = part_trie.ROUNDS) -> str:
    """All distances of every round; whole numbers in doubles, which are exact here."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
              SELECT id, p, any_value(x) AS x, min(struct_pack(far := far, k := k)) AS best FROM (
                SELECT id, parts.p, x, k, list_inner_product(x, x) - 2 * list_inner_product(x, c)
                       + list_inner_product(c, c) AS far
                FROM parts JOIN c{r} ON parts.p = c{r}.p) GROUP BY id, p)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
              SELECT p, k, list(mean ORDER BY i) AS c FROM (
                SELECT p, best.k AS k, i, floor(sum(x[i]) / count(*)) AS mean
                FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM a{r}) GROUP BY p, best.k, i) GROUP BY p, k),
            c{r + 1} AS MATERIALIZED (
              SELECT c{r}.p, c{r}.k, coalesce(m{r}.c, c{r}.c) AS c
              FROM c{r} LEFT JOIN m{r} ON c{r}.p = m{r}.p AND c{r}.k = m{r}.k)""")
    return f"""WITH
            kept AS (
              SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label,
                     list_transform(embedding, lambda x: floor({part_trie.SCALE} * CAST(x AS DOUBLE))) AS v
              FROM embeddings
              WHERE len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
            parts AS MATERIALIZED (
              SELECT id, p, v[p * len(v) // {n_parts} + 1 : (p + 1) * len(v) // {n_parts}] AS x
              FROM (SELECT *, unnest(range({n_parts})) AS p FROM kept)),
            c0 AS MATERIALIZED (SELECT p, id - 1 AS k, x AS c FROM parts WHERE id <= {n_entries}),
            {", ".join(steps)},
            rows_ AS (
              SELECT id, string_agg(printf('%02x', best.k), '' ORDER BY p) AS code,
                     CAST(sum(best.far) AS BIGINT) AS error
              FROM a{rounds} GROUP BY id),
            sha AS (
              SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, k, i)) AS codebooks_sha256
              FROM (SELECT p, k, unnest(c) AS y, unnest(range(len(c))) AS i FROM c{rounds}))
            SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
                   codebooks_sha256
            FROM kept JOIN rows_ USING (id), sha"""
