"""The operators of this folder as registered queries over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from docmeld.llm import divergence, exact_dedup, fingerprint, html_blocks, language, lattice, licenses, merkle, mixing, ngram_join, packing, pii, toxicity
from docmeld.llm.common import fold

#: Vocabularies: of the packing tokenizer, and of the scored pieces.
PACKING_VOCABULARY, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{kind}") for k, kind in enumerate(pii.BASE_KINDS)),
        F.sha2(pii.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"),
    )


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.neighbours(table(spark, sf_dir, "documents"))


def op3_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(table(spark, sf_dir, "documents"), lattice.training_rows(), vocabulary(PIECES))


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs, language.training_rows()))
    return found.select("doc_id", (~language.training_rows()).alias("held_out"), "lang_pred", "score", F.array_join("languages", ",").alias("languages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"])))
    more = F.array_sort(F.array_distinct(F.concat(base, F.transform("found", lambda x: x["label"]))))
    starts = F.transform("places", lambda x: x["at"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), F.array_join(base, ",").alias("base_labels"), F.array_join(more, ",").alias("labels"), "score",
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.training_rows()))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"), words=3, least=90)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit(table(spark, sf_dir, "documents"), vocabulary(PACKING_VOCABULARY))


def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.when(fold(F.col("doc_id"), 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(table(spark, sf_dir, "documents"), {"n_chars": tampered})
    folded = found.withColumn("folded_root", merkle.folded(F.col("claimed"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_spans, op2_order_minhash, op3_lattice_score, op4_language_mixture, op5_license_scan,
        op6_exact_dedup, op7_toxicity, op8_ngram_join, op9_mixing, op10_packing, op11_html_text, op12_source_divergence, op13_merkle_manifest,
    )
}

ORACLE = {
    "op6_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
        )
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY t)
    """,
    "op8_ngram_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                                                WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
            FROM w
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM s AS a JOIN s AS b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN n AS na ON na.doc_id = a.doc_id JOIN n AS nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id
        FROM documents AS d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) AS r ON r.a = d.doc_id
    """,
    # At the final level L the sources at or above their limit are those whose limit is at most L times their weight.
    # Adding sources in the order of limit over weight, the first that stays below its limit ends the list.
    "op9_mixing": r"""
        WITH s AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(text, '')) AS digest FROM documents
        ), by_source AS (
            SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source
        ), weighted AS (
            SELECT *, CASE (row_number() OVER (ORDER BY source COLLATE "binary" NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
                   2.0::DOUBLE * source_size AS cap
            FROM by_source
        ), ordered AS (
            SELECT *, sum(cap) OVER o - cap AS stopped, sum(w) OVER () - (sum(w) OVER o - w) AS open_weight,
                   1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE AS total, row_number() OVER o AS k
            FROM weighted WINDOW o AS (ORDER BY cap / w, source COLLATE "binary" NULLS LAST)
        ), level AS (
            SELECT (total - stopped) / open_weight AS level FROM ordered WHERE cap / w > (total - stopped) / open_weight ORDER BY k LIMIT 1
        ), targets AS (
            SELECT source, source_size, least(cap, coalesce(level, 0.0::DOUBLE) * w) AS target FROM weighted LEFT JOIN level ON true
        ), rated AS (
            SELECT doc_id, size, digest, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate
            FROM s JOIN targets ON s.source IS NOT DISTINCT FROM targets.source
        )
        SELECT doc_id, size, source_size, target,
               ((floor(rate) + CASE WHEN ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || digest), 1, 12))::UBIGINT / 281474976710656.0::DOUBLE < rate - floor(rate)
                                    THEN 1 ELSE 0 END) * size)::BIGINT AS taken
        FROM rated
    """,
    "op12_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), t AS (
            SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ), kept AS (
            SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3
        ), v AS (
            SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang
        ), c AS (
            SELECT lang, source, term, count(*)::HUGEINT AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
        ), g AS (
            SELECT DISTINCT lang, source FROM d
        ), total AS (
            SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM g LEFT JOIN c USING (lang, source) GROUP BY lang, source
        ), p AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (total.total + v.v) AS p
            FROM g JOIN kept AS k USING (lang) JOIN total USING (lang, source) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), lang_total AS (
            SELECT lang, sum(total)::HUGEINT AS total FROM total GROUP BY lang
        ), q AS (
            SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (coalesce(sum(c.n), 0)::HUGEINT + 1)) // (any_value(lang_total.total) + any_value(v.v)) AS q
            FROM kept AS k JOIN lang_total USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = k.lang AND c.term = k.term GROUP BY k.lang, k.term
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
            FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), all_pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
            FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
        ), more AS (
            SELECT p.lang, p.source, 'term' AS part, p.term AS item, ((p.p - q.q) * (p.p - q.q) // q.q)::BIGINT AS value FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
        )
        SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM all_pairs
        UNION ALL
        SELECT *, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM more QUALIFY rank <= 200
    """,
    # CRC-32 bit by bit; levels of all trees by recursion; the path of a leaf is the neighbour of its ancestor at each level.
    "op13_merkle_manifest": r"""
        WITH RECURSIVE d AS (
            SELECT *, list_reduce([4294967295::UBIGINT] || list_transform(list_filter(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: c <> ''), lambda c: ord(c)::UBIGINT),
                       lambda crc, c: list_reduce([xor(crc, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384::UBIGINT * (r & 1)))) AS crc
            FROM documents
        ), f AS (
            SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
                   coalesce(strlen(text) || ':' || text, '-') AS z, n_chars + (xor(crc, 4294967295::UBIGINT) % 7 = 0)::BIGINT AS m, coalesce('=' || lang, '-') AS tree
            FROM d
        ), l AS (
            SELECT doc_id, tree, sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS leaf, sha256(a || coalesce(strlen(m::VARCHAR) || ':' || m, '-') || z) AS claimed,
                   row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
            FROM f
        ), nodes AS (
            SELECT tree, 0 AS level, i, n, leaf AS h FROM l
            UNION ALL SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY tree, level, i // 2, n
        ), roots AS (
            SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
        ), top AS (
            SELECT 0 AS level, i, n, subroot AS h FROM roots
            UNION ALL SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 2, n
        ), lower_path AS (
            SELECT l.tree, l.i, list(CASE WHEN s.h IS NULL THEN '-' WHEN s.i % 2 = 0 THEN 'L' || s.h ELSE 'R' || s.h END ORDER BY o.level) AS path
            FROM l JOIN nodes AS o ON o.tree = l.tree AND o.i = l.i >> o.level AND o.n > 1 LEFT JOIN nodes AS s ON s.tree = o.tree AND s.level = o.level AND s.i = xor(o.i, 1)
            GROUP BY l.tree, l.i
        ), upper_path AS (
            SELECT r.tree, list(CASE WHEN s.h IS NULL THEN '-' WHEN s.i % 2 = 0 THEN 'L' || s.h ELSE 'R' || s.h END ORDER BY o.level) AS path
            FROM roots AS r JOIN top AS o ON o.i = r.i >> o.level AND o.n > 1 LEFT JOIN top AS s ON s.level = o.level AND s.i = xor(o.i, 1)
            GROUP BY r.tree
        ), p AS (
            SELECT l.doc_id, l.leaf, l.claimed, r.subroot, t.h AS root, coalesce(a.path, []) || coalesce(b.path, []) AS path
            FROM l JOIN roots AS r ON r.tree = l.tree JOIN top AS t ON t.n = 1 LEFT JOIN lower_path AS a ON a.tree = l.tree AND a.i = l.i LEFT JOIN upper_path AS b ON b.tree = l.tree
        ), g AS (
            SELECT *, list_reduce([claimed] || path, lambda h, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || h WHEN 'R' THEN h || s[2:] ELSE h END)) AS folded_root FROM p
        )
        SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(list_filter(path, lambda s: s <> '-'), lambda s: s[2:]), ''), '')) AS proof_sha256, folded_root, folded_root = root AS verified
        FROM g
    """,
}
