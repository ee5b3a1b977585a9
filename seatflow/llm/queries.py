"""The registered queries of the text operators, each over its whole table, and SQL for those that SQL can state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatflow.llm import bpe, collocations, fingerprints, language, lines, media, merkle, mixing, pages, quality, simhash, substring, suffixes
from seatflow.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def sha256(c: str) -> Column:
    return F.sha2(F.col(c).cast("binary"), 256)


def op1_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", sha256("kept").alias("kept_sha256"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pages.extracted(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), sha256("kept").alias("kept_sha256"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coder = bpe.shared_coder(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    out = bpe.encode(table(spark, sf_dir, "documents"), coder, decoded=True)
    ids = F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), sha256("decoded").alias("decoded_sha256"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.sizes("text").alias("size"))
    return mixing.mixed_copies(sized).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op9_matroska_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = media.stored_media(table(spark, sf_dir, "documents"))
    files = files.withColumns({"media_bytes": F.length("media").cast("long"), "media_sha256": sha256("media")})
    read = media.packet_tables(files, keep=("doc_id", "n_bytes", "media_bytes", "media_sha256"))
    ticks = F.coalesce(F.element_at("packets", -1)["timestamp"] + F.element_at("packets", -1)["end"] - F.element_at("packets", -1)["begin"], F.lit(0))
    feature = F.concat_ws(";", F.concat(F.lit("codec="), F.element_at("tracks", 1)["codec"]), F.concat(F.lit("packets="), F.size("packets")), F.concat(F.lit("cues="), F.size("cues")), F.concat(F.lit("ticks="), ticks))
    return read.select(
        "doc_id", "n_bytes", F.length("payload").cast("long").alias("payload_bytes"), sha256("payload").alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"), "media_bytes", "media_sha256", feature.alias("feature"),
    )


def op10_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.scored(table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", sha256("kept").alias("kept_sha256"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0) & F.col("text").isNotNull()
    offered = F.when(tampered, merkle.leaf_of(*[F.translate("text", lines.UPPER, lines.LOWER) if c == "text" else F.col(c) for c in merkle.FIELDS]))
    out = merkle.manifest(docs.withColumn("offered", offered), keep=["offered"])
    out = out.withColumn("folded_root", merkle.folded(F.coalesce("offered", "leaf"), "siblings", "shape"))
    proof = F.sha2(F.lower(F.hex("siblings")).cast("binary"), 256)
    return out.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_minhash_fingerprints, op2_substring_dedup, op3_html_extraction, op4_suffix_array_dedup, op5_byte_bpe, op6_simhash_near_dedup,
    op7_quality_classifier, op8_mixing, op9_matroska_media, op10_backoff_automaton, op11_line_dedup, op12_phrase_collocations, op13_merkle_manifest, pipeline,
)}


def _tree_sql(tree: str, levels: int) -> list[str]:
    """Runs of 16 and what they become, level by level, from {tree}_0 (s, pos, d, n)."""
    out = []
    for i in range(levels):
        out.append(f"""{tree}_runs_{i} AS (SELECT s, pos // 16 AS run, list(d ORDER BY pos) AS ds, max(n) AS n FROM {tree}_{i} GROUP BY s, pos // 16)""")
        out.append(f"""{tree}_{i + 1} AS (SELECT s, run AS pos, CASE WHEN n = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS d, (n + 15) // 16 AS n FROM {tree}_runs_{i})""")
    return out


def _path_sql(path: str, tree: str, levels: int) -> list[str]:
    """From {path}_0 (place, s, pos, proof, leaf) up the tree: siblings are added to the proof, and the leaf is folded."""
    out = []
    for i in range(levels):
        left, right = "array_to_string(ds[1 : pos % 16], '')", "array_to_string(ds[pos % 16 + 2 : 16], '')"
        out.append(f"""{path}_{i + 1} AS (SELECT place, s, pos // 16 AS pos, CASE WHEN n = 1 THEN proof ELSE proof || {left} || {right} END AS proof,
            CASE WHEN n = 1 THEN leaf ELSE sha256({left} || leaf || {right}) END AS leaf FROM {path}_{i} JOIN {tree}_runs_{i} USING (s) WHERE {tree}_runs_{i}.run = pos // 16)""")
    return out


#: Levels of 16 that the SQL below has: over documents of a source, and over sources.
_DOCUMENT_LEVELS, _SOURCE_LEVELS = 5, 3
_LEAF = "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
#: CRC-32 of an id's digits, bit by bit.
_CRC = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda c, x: CASE WHEN xor(c, x) % 2 = 1 THEN xor(xor(c, x) >> 1, 3988292384::BIGINT) ELSE xor(c, x) >> 1 END), 4294967295::BIGINT)"""
_MERKLE = ",\n".join([
    f"""WITH leaves AS (SELECT doc_id, coalesce('s' || source, '') AS s, {_LEAF.format(text="text")} AS leaf, {_CRC} % 5 = 0 AS tampered,
        {_LEAF.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS other FROM documents)""",
    "placed AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER () AS place, count(*) OVER (PARTITION BY s) AS n FROM leaves)",
    "doc_0 AS (SELECT s, pos, leaf AS d, n FROM placed)", *_tree_sql("doc", _DOCUMENT_LEVELS),
    f"subroots AS (SELECT s AS name, d AS subroot FROM doc_{_DOCUMENT_LEVELS})",
    "src_0 AS (SELECT '' AS s, row_number() OVER (ORDER BY name) - 1 AS pos, subroot AS d, count(*) OVER () AS n, name FROM subroots)", *_tree_sql("src", _SOURCE_LEVELS),
    "up_0 AS (SELECT place, s, pos, '' AS proof, CASE WHEN coalesce(tampered, false) THEN other ELSE leaf END AS leaf FROM placed)", *_path_sql("up", "doc", _DOCUMENT_LEVELS),
    f"on_0 AS (SELECT place, src_0.s, src_0.pos, proof, leaf FROM up_{_DOCUMENT_LEVELS} AS up JOIN src_0 ON src_0.name = up.s)", *_path_sql("on", "src", _SOURCE_LEVELS),
]) + f"""
    SELECT doc_id, placed.leaf AS leaf, subroot, root.d AS root, sha256(proof) AS proof_sha256, folded.leaf AS folded_root, folded.leaf = root.d AS verified
    FROM placed JOIN on_{_SOURCE_LEVELS} AS folded USING (place) JOIN subroots ON subroots.name = placed.s CROSS JOIN src_{_SOURCE_LEVELS} AS root
"""  # fmt: skip

ORACLE_SQL = {
    "op13_merkle_manifest": _MERKLE,
    "op2_substring_dedup": r"""
        WITH docs AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
        starts AS (SELECT doc_id, words, unnest(range(len(words) - 49)) AS p FROM docs WHERE len(words) >= 50),
        windows AS (SELECT doc_id, p, md5(array_to_string(words[p + 1 : p + 50], ' ')) AS w FROM starts),
        firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p + 1, p + 51)) AS i FROM windows JOIN firsts USING (w) WHERE doc_id > first),
        lost AS (SELECT doc_id, count(*) AS lost FROM gone GROUP BY doc_id),
        each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(lost, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM docs LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
    """,
    "op4_suffix_array_dedup": r"""
        WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        starts AS (SELECT doc_id, h, unnest(range(len(h) // 2 - 199)) AS p FROM docs WHERE len(h) >= 400),
        strings AS (SELECT doc_id, p, md5(substr(h, CAST(2 * p + 1 AS BIGINT), 400)) AS m FROM starts),
        twice AS (SELECT m FROM strings GROUP BY m HAVING count(*) > 1),
        marked AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM strings SEMI JOIN twice USING (m)),
        runs AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p - before > 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
        spans AS (SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM runs GROUP BY doc_id, run),
        gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS free FROM spans),
        cut AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS ends,
            string_agg(substr(h, CAST(2 * free + 1 AS BIGINT), CAST(2 * (a - free) AS BIGINT)), '' ORDER BY a) AS head FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
            sha256(unhex(coalesce(head, '') || substr(h, CAST(2 * coalesce(ends, 0) + 1 AS BIGINT)))) AS kept_sha256 FROM docs LEFT JOIN cut USING (doc_id)
    """,
    "op8_mixing": r"""
        WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
        dealt AS (SELECT *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) AS cls,
            CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) % 256 AS sub FROM sized),
        placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY cls, sub, size, doc_id) AS place FROM dealt),
        totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sized GROUP BY source),
        filled AS (SELECT *, source_size * 3.0::DOUBLE AS ceiling, source_size * 3.0::DOUBLE / weight AS filled_at FROM totals),
        levels AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(ceiling) OVER (ORDER BY filled_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY filled_at, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM filled),
        level AS (SELECT arg_min(level, filled_at) FILTER (WHERE level <= filled_at) AS level FROM levels),
        plan AS (SELECT source, source_size, coalesce(least(ceiling, level.level * weight), ceiling) AS target,
            CAST('0x' || substr(md5(coalesce(source, '') || '/42'), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS shift FROM filled, level),
        mixed AS (SELECT doc_id, size, source_size, target, place, shift, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS each
            FROM placed JOIN plan ON placed.source IS NOT DISTINCT FROM plan.source),
        drawn AS (SELECT *, CAST(greatest(0, least(3, floor(place * each + shift) - floor((place - 1) * each + shift))) AS INTEGER) AS copies FROM mixed)
        SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, size * copies AS taken, copies FROM drawn
    """,
    "op11_line_dedup": r"""
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM split),
        keyed AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        held AS (SELECT key, count(DISTINCT doc_id) AS n, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
        marked AS (SELECT keyed.doc_id, pos, line, coalesce(n >= 2 AND keyed.doc_id > first, false) AS gone FROM keyed LEFT JOIN held USING (key))
        SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
            sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256 FROM marked GROUP BY doc_id
    """,
    "op12_phrase_collocations": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        lists AS (SELECT row_number() OVER () AS piece, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
        places AS (SELECT piece, lang, unnest(words) AS w, unnest(range(len(words))) AS p FROM lists),
        next AS (SELECT lang, w, lead(w, 1) OVER (PARTITION BY piece ORDER BY p) AS v, lead(w, 2) OVER (PARTITION BY piece ORDER BY p) AS u FROM places),
        grams AS (SELECT lang, w AS phrase, 1 AS k FROM next UNION ALL SELECT lang, w || ' ' || v, 2 FROM next UNION ALL SELECT lang, w || ' ' || v || ' ' || u, 3 FROM next),
        counts AS (SELECT lang, phrase, k, count(*) AS f FROM grams WHERE phrase IS NOT NULL GROUP BY lang, phrase, k HAVING count(*) >= 10),
        totals AS (SELECT lang, count(*) AS n FROM next GROUP BY lang),
        candidates AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
        cuts AS (SELECT lang, phrase, a, 1 AS cut, w[1] AS first, array_to_string(w[2:3], ' ') AS rest FROM candidates
            UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM candidates WHERE k = 3),
        lefts AS (SELECT cuts.*, f AS l FROM cuts JOIN counts ON counts.lang = cuts.lang AND counts.phrase = first),
        scores AS (SELECT lefts.*, f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * f) AS score FROM lefts JOIN counts ON counts.lang = lefts.lang AND counts.phrase = rest),
        least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scores),
        longer AS (SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a AS f FROM candidates WHERE k = 3),
        longest AS (SELECT lang, phrase, max(f) AS f FROM longer GROUP BY lang, phrase),
        kept AS (SELECT least.* FROM least LEFT JOIN longest ON least.lang = longest.lang AND least.phrase = longest.phrase
            WHERE nth = 1 AND (longest.f IS NULL OR 100 * longest.f < 50 * a)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
