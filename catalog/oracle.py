"""DuckDB SQL that computes the same results in its own way, with global windows."""

from __future__ import annotations

from catalog.queries import BATCH, BLOCKS_PER_SHARD, LANES, MORE_LANES, SEED, SEQ_LEN, VOCABULARY, WORLD

# A token is two characters: the hex form of a byte, or ZZ for end-of-text.
HEX = "hex(encode(text))"
WORDS = r"list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda w: w <> '')"


def unit(*keys: str) -> str:
    text = " || '|' || ".join([f"'{SEED}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE))"


def ids_of(hex_text: str) -> str:
    return (
        f"list_transform(regexp_extract_all({hex_text}, '..'), "
        "lambda t: CASE WHEN t = 'ZZ' THEN 256 ELSE CAST('0x' || t AS INTEGER) END)"
    )


def digest(ids: str) -> str:
    return f"md5(coalesce(array_to_string({ids}, ','), ''))"


def chain(*parts: tuple[str, str]) -> str:
    return "WITH " + ", ".join(f"{name} AS MATERIALIZED ({body})" for name, body in parts) + " "


CORPUS = ("corpus", """
    SELECT 'documents' AS source, doc_id, text, 5.0::DOUBLE AS weight FROM documents
    UNION ALL SELECT 'conversations', conv_id * 100000 + turn, text, 2.0 FROM conversations
    UNION ALL SELECT 'pages', page_id, html, 1.5 FROM pages
    UNION ALL SELECT 'benchmark', item_id, text, 0.5 FROM benchmark""")
DOCS = ("corpus", """
    SELECT source, doc_id, text, 1.0::DOUBLE + CAST(substr(source, 4) AS INTEGER) % 3 AS weight
    FROM documents""")
STATS = ("stats", """
    SELECT source, weight, count(*) AS n_records, count(*) FILTER (text <> '') AS n_docs,
           CAST(coalesce(sum(strlen(text) + 1) FILTER (text <> ''), 0) AS BIGINT) AS tokens,
           CAST(coalesce(max(strlen(text) + 1) FILTER (text <> ''), 0) AS BIGINT) AS longest
    FROM corpus GROUP BY source, weight""")
TOTAL = ("total", "SELECT CAST(sum(tokens) AS BIGINT) AS tokens FROM stats")


def placed(horizon: int | None = None) -> list[tuple[str, str]]:
    """All documents with arrival time and hex tokens, one epoch or up to a horizon."""
    epochs = "[0]"
    limit = ""
    if horizon is not None:
        epochs = "range(0, CAST(ceil(horizon * weight / n_records) AS BIGINT))"
        limit = "WHERE arrival < horizon"
    return [
        ("reach", f"SELECT {horizon or 1} * max(n_records / weight) AS horizon FROM stats"),
        ("repeated", f"""
            SELECT source, weight, n_records, horizon, doc_id, unnest({epochs}) AS epoch,
                   strlen(text) + 1 AS len, {HEX} || 'ZZ' AS h
            FROM corpus JOIN stats USING (source, weight), reach WHERE text <> ''"""),
        ("placed", f"""
            SELECT * FROM (
                SELECT source, epoch, doc_id, len, h, horizon,
                       (epoch + {unit('source', 'epoch', 'doc_id')}) * n_records / weight AS arrival
                FROM repeated) {limit}"""),
        ("ordered", """
            SELECT *, row_number() OVER (ORDER BY arrival, source, epoch, doc_id) AS pos
            FROM placed"""),
    ]


def cuts(caps: dict[str, str], budget_blocks: str = "1000000000000") -> list[tuple[str, str]]:
    """Cap fixpoint, one round per capped source and a last one that finds nothing."""
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS source, {cap} AS cap FROM total" for name, cap in caps.items()
    )
    parts = [
        ("caps", rows),
        ("bound", f"SELECT {budget_blocks} AS n_blocks FROM total"),
        ("cut0", "SELECT '' AS source, CAST(0 AS BIGINT) AS pos WHERE false"),
    ]
    for i in range(len(caps)):
        parts += [
            (f"run{i}", f"""
                SELECT source, pos, {SEQ_LEN} * sum(
                    least(upto // {SEQ_LEN}, n_blocks) - least((upto - len) // {SEQ_LEN}, n_blocks)
                ) OVER (PARTITION BY source ORDER BY pos) AS run
                FROM (SELECT o.source, o.pos, len, CAST(sum(len) OVER (ORDER BY o.pos) AS BIGINT) AS upto
                      FROM ordered o LEFT JOIN cut{i} c ON o.source = c.source
                      WHERE c.pos IS NULL OR o.pos <= c.pos), bound"""),
            (f"cut{i + 1}", f"""
                SELECT * FROM cut{i} UNION ALL
                (SELECT source, pos FROM run{i} JOIN caps USING (source)
                 WHERE run >= cap AND source NOT IN (SELECT source FROM cut{i})
                 ORDER BY pos LIMIT 1)"""),
        ]
    return parts


def spans(n_caps: int | None = None) -> list[tuple[str, str]]:
    kept = "SELECT * FROM ordered" if n_caps is None else f"""
        SELECT o.* FROM ordered o LEFT JOIN cut{n_caps} c ON o.source = c.source
        WHERE c.pos IS NULL OR o.pos <= c.pos"""
    return [("spans", f"""
        SELECT *, CAST(sum(len) OVER (ORDER BY pos) - len AS BIGINT) AS off FROM ({kept})""")]


FRAGMENTS = ("fragments", f"""
    SELECT source, doc_id, off, b AS block_id,
           substr(h, 2 * (greatest(off, b * {SEQ_LEN}) - off) + 1,
                  2 * (least(off + len, (b + 1) * {SEQ_LEN}) - greatest(off, b * {SEQ_LEN}))) AS piece
    FROM (SELECT *, unnest(range(off // {SEQ_LEN}, (off + len - 1) // {SEQ_LEN} + 1)) AS b FROM spans)""")
BLOCKS = ("blocks", f"""
    SELECT block_id, arg_max(source, off) AS source, count(*) AS n_docs,
           string_agg(piece, '' ORDER BY off) AS h
    FROM fragments GROUP BY block_id HAVING sum(length(piece)) = 2 * {SEQ_LEN}""")

DOC_SPANS = chain(DOCS, STATS, TOTAL, *placed(), *spans())
DOC_FRAGMENTS = chain(DOCS, STATS, TOTAL, *placed(), *spans(), FRAGMENTS)
DOC_BLOCKS = chain(DOCS, STATS, TOTAL, *placed(), *spans(), FRAGMENTS, BLOCKS)
CAPS = {"src3": "tokens // 100", "src7": "tokens // 30", "src11": "tokens * 10"}
CAPPED = [DOCS, STATS, TOTAL, *placed(), *cuts(CAPS), *spans(len(CAPS))]
MIX_CAPS = {"pages": "tokens // 10", "benchmark": "tokens // 50"}
BUDGET = f"(tokens * 3 // 2 + {SEQ_LEN - 1}) // {SEQ_LEN}"
MIXED = chain(
    CORPUS, STATS, TOTAL, *placed(4), *cuts(MIX_CAPS, BUDGET), *spans(len(MIX_CAPS)), FRAGMENTS, BLOCKS
)
DIGEST = digest(ids_of("h"))
SHARD = f"CAST(block_id // {BLOCKS_PER_SHARD} AS INTEGER)"


def file_name(shard: str) -> str:
    return f"'shard-' || lpad(CAST({shard} AS VARCHAR), 6, '0') || '.parquet'"


SHARDS = f"""
    SELECT {SHARD} AS shard_id, {file_name(SHARD)} AS file, count(*) AS "rows",
           CAST(count(*) * {SEQ_LEN} AS BIGINT) AS tokens
    FROM blocks GROUP BY ALL"""
DOC_SHARDS = DOC_BLOCKS.rstrip() + f", shards AS ({SHARDS}) "


def strided(order: str) -> str:
    return f"""{DOC_SHARDS}, lined AS (
        SELECT shard_id, file, CAST(row_number() OVER (ORDER BY {order}) - 1 AS BIGINT) AS pos FROM shards),
    ranks AS (SELECT shard_id, file, CAST(pos % {WORLD} AS INTEGER) AS rank, pos // {WORLD} AS shard_pos
              FROM lined) """


BY_HASH = f"{unit('file')}, file"


def batches(order: str) -> str:
    return f"""{strided(order)}, lines AS (
        SELECT rank, h, block_id, CAST(row_number() OVER (
            PARTITION BY rank ORDER BY shard_pos, block_id) - 1 AS BIGINT) AS pos
        FROM blocks JOIN ranks ON {SHARD} = shard_id),
    batches AS (SELECT rank, pos // {BATCH} AS batch_id, count(*) AS n_rows,
                       string_agg(h, '' ORDER BY pos) AS h
                FROM lines GROUP BY ALL) """


LOG = """WITH log AS (
    SELECT user_id AS run, ts, event_id, opt_step, opt_step * 8 + event_id % 3 AS micro_step,
           CASE WHEN event_id % 97 = 0 THEN CAST('nan' AS DOUBLE)
                WHEN event_id % 89 = 0 THEN CAST('inf' AS DOUBLE) ELSE value END AS loss
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS opt_step
          FROM events)) """
VOCAB = ("vocab", f"""
    SELECT word, count, id FROM (
        SELECT word, count(*) AS count, CAST(row_number() OVER (ORDER BY count(*) DESC, word) AS INTEGER) AS id
        FROM (SELECT unnest({WORDS}) AS word FROM documents) GROUP BY word)
    WHERE id <= {VOCABULARY}""")
ENCODED = ("encoded", f"""
    SELECT doc_id, list(coalesce(id, 0) ORDER BY place) AS ids
    FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place
          FROM (SELECT doc_id, {WORDS} AS words FROM documents)) LEFT JOIN vocab USING (word)
    GROUP BY doc_id""")
ENCODE_WORDS = chain(VOCAB, ENCODED) + f"""
    SELECT doc_id, CAST(coalesce(len(ids), 0) AS INTEGER) AS n_ids, {digest('ids')} AS digest
    FROM documents LEFT JOIN encoded USING (doc_id)"""
PACK_WORDS = chain(
    VOCAB, ENCODED, DOCS,
    ("stats", "SELECT source, count(*) AS n_records FROM corpus GROUP BY source"),
    ("eos", "SELECT CAST(count(*) + 1 AS INTEGER) AS eos FROM vocab"),
    ("spans", f"""
        SELECT *, CAST(sum(len) OVER (ORDER BY arrival, source, doc_id) - len AS BIGINT) AS off
        FROM (SELECT source, doc_id, list_append(ids, eos) AS ids, len(ids) + 1 AS len,
                     (0 + {unit('source', '0', 'doc_id')}) * n_records / weight AS arrival
              FROM corpus JOIN stats USING (source) JOIN encoded USING (doc_id), eos)"""),
    ("fragments", f"""
        SELECT source, off, b AS block_id,
               list_slice(ids, greatest(off, b * {SEQ_LEN}) - off + 1,
                          least(off + len, (b + 1) * {SEQ_LEN}) - off) AS piece
        FROM (SELECT *, unnest(range(off // {SEQ_LEN}, (off + len - 1) // {SEQ_LEN} + 1)) AS b FROM spans)"""),
) + f"""
    SELECT block_id, arg_max(source, off) AS source, count(*) AS n_docs,
           {digest('flatten(list(piece ORDER BY off))')} AS digest
    FROM fragments GROUP BY block_id HAVING sum(len(piece)) = {SEQ_LEN}"""

STREAM = f"""WITH lanes AS (
    SELECT source, CAST(floor({unit('source', 'doc_id')} * {LANES}) AS INTEGER) AS lane,
           CAST(sum(strlen(text) + 1) // {SEQ_LEN} AS BIGINT) AS n_blocks
    FROM documents WHERE text <> '' GROUP BY ALL) """

# Lanes of the documents that arrive late: by the blocks that their source has before.
STREAM_LANES = f"""WITH docs AS (
    SELECT source, {unit('source', 'doc_id')} AS u, strlen(text) + 1 AS n, coalesce(lang = 'en', false) AS early
    FROM documents WHERE text <> ''),
  early AS (
    SELECT source, CAST(floor(u * {LANES}) AS INTEGER) AS lane, sum(n) // {SEQ_LEN} AS n_blocks
    FROM docs WHERE early GROUP BY ALL),
  volumes AS (SELECT source, sum(n_blocks) AS v FROM early GROUP BY source HAVING sum(n_blocks) > 0),
  plan AS (
    SELECT source, greatest({LANES}, ({MORE_LANES} * v + sum(v) OVER () - 1) // sum(v) OVER ()) AS lanes FROM volumes),
  lanes AS (
    SELECT docs.source, CAST(floor(u * CASE WHEN early THEN {LANES} ELSE coalesce(lanes, 16) END) AS INTEGER) AS lane,
           CAST(sum(n) // {SEQ_LEN} AS BIGINT) AS n_blocks
    FROM docs LEFT JOIN plan ON docs.source = plan.source GROUP BY ALL) """

HALF = f"(tokens * 3 // 2 // 2 + {SEQ_LEN - 1}) // {SEQ_LEN}"

MASK_STATS = DOC_BLOCKS + f"""
    SELECT shard_id, n - stops AS valid_labels, n - stops AS mask_sum, n AS elements
    FROM (SELECT {SHARD} AS shard_id, CAST(count(*) * {SEQ_LEN} AS BIGINT) AS n,
                 CAST(sum(length(h) - length(replace(h, 'ZZ', ''))) // 2 AS BIGINT) AS stops
          FROM blocks GROUP BY 1)"""

ORACLE: dict[str, str] = {
    "scan_text": chain(CORPUS) + "SELECT source, doc_id, md5(text) AS digest FROM corpus",
    "source_specs": chain(CORPUS) + """
        SELECT CAST(CASE source WHEN 'documents' THEN 0 WHEN 'conversations' THEN 1
                                WHEN 'pages' THEN 2 ELSE 3 END AS INTEGER) AS position,
               source AS name, CASE source WHEN 'pages' THEN 'html' ELSE 'text' END AS text_col,
               weight, count(*) AS n_records
        FROM corpus GROUP BY source, weight""",
    "scan_packed": DOC_BLOCKS + f"""
        SELECT block_id, source, {SHARD} AS shard_id, {file_name(SHARD)} AS file, {DIGEST} AS digest
        FROM blocks""",
    "stream_packed": DOC_BLOCKS + f"SELECT block_id, source, {SHARD} AS shard_id, {DIGEST} AS digest FROM blocks",
    "scan_manifest": DOC_SHARDS + 'SELECT file, "rows", tokens FROM shards',
    "shard_bytes": DOC_SHARDS + "SELECT file, CAST(64 AS INTEGER) AS digest_chars, shard_id <> 0 AS same FROM shards "
        "WHERE shard_id < (SELECT max(shard_id) FROM shards)",
    "load_state": DOC_BLOCKS + f""", tail AS (
            SELECT coalesce(string_agg(piece, '' ORDER BY off), '') AS h FROM fragments
            WHERE block_id NOT IN (SELECT block_id FROM blocks)),
        written AS (SELECT count(*) AS n FROM blocks)
        SELECT (n + {BLOCKS_PER_SHARD - 1}) // {BLOCKS_PER_SHARD} AS shard_idx,
               n * {SEQ_LEN} AS total_tokens_written, {SEQ_LEN} AS seq_len,
               {BLOCKS_PER_SHARD} AS blocks_per_shard, {digest(ids_of('tail.h'))} AS carry_digest,
               source, count(*) * {SEQ_LEN} AS tokens
        FROM blocks, tail, written GROUP BY n, tail.h, source""",
    "write_shards": DOC_SHARDS + 'SELECT shard_id, file, CAST(1 AS BIGINT) AS files, "rows", tokens FROM shards',
    "audit_manifest": DOC_SHARDS + """
        SELECT file, CAST(1 AS BIGINT) AS lines, "rows", tokens,
               CASE shard_id WHEN (SELECT max(shard_id) FROM shards) THEN 'no file'
                    WHEN 0 THEN 'other content' ELSE 'ok' END AS verdict FROM shards
        UNION ALL SELECT 'shard-500000.parquet', NULL, NULL, NULL, 'no line'""",
    "publish_shards": DOC_BLOCKS + f"""
        SELECT block_id, source, {SHARD} AS shard_id, {DIGEST} AS digest, 'ok' AS verdict,
               count(*) OVER (PARTITION BY {SHARD}) AS "rows" FROM blocks""",
    "missing_shards": DOC_SHARDS + """
        SELECT file, CASE shard_id WHEN 1 THEN 'no line' ELSE 'no file' END AS problem
        FROM shards WHERE shard_id IN (1, 2)""",
    "tokenize_bytes": f"""
        SELECT doc_id, CAST(strlen(text) AS INTEGER) AS n_ids, {digest(ids_of(HEX))} AS digest
        FROM documents WHERE text <> ''""",
    "build_vocab": chain(VOCAB) + "SELECT * FROM vocab",
    "encode_words": ENCODE_WORDS,
    "validate_specs": """
        SELECT source, CASE WHEN sum(strlen(text)) - 10 * max(strlen(text)) <= 0 THEN 'cap'
            WHEN count(*) % 3 = 0 THEN 'weight' ELSE 'none' END AS error
        FROM documents GROUP BY source""",
    "pack_words": PACK_WORDS,
    "pack_words_budget": PACK_WORDS + f"""
        AND block_id < (SELECT (CAST(sum(strlen(text) + 1) AS BIGINT) // 100 + {SEQ_LEN - 1}) // {SEQ_LEN}
                        FROM documents WHERE text <> '')""",
    "append_eos": f"""
        SELECT doc_id, CAST(strlen(text) + 1 AS INTEGER) AS n_ids,
               {digest(ids_of(HEX + " || 'ZZ'"))} AS digest
        FROM documents WHERE text <> ''""",
    "block_slices": DOC_FRAGMENTS + f"""
        SELECT doc_id, block_id, CAST(length(piece) // 2 AS INTEGER) AS n_ids,
               {digest(ids_of('piece'))} AS digest FROM fragments""",
    "attention_mask": DOC_BLOCKS + f"""
        SELECT block_id, {digest(f"list_transform({ids_of('h')}, lambda x: CAST(x <> 256 AS INTEGER))")} AS digest
        FROM blocks""",
    "lm_labels": DOC_BLOCKS + f"""
        SELECT block_id,
               {digest(f"list_transform({ids_of('h')}, lambda x: CASE WHEN x <> 256 THEN x ELSE -100 END)")} AS digest
        FROM blocks""",
    "long_ids": DOC_BLOCKS + f"SELECT block_id, {DIGEST} AS digest FROM blocks",
    "shard_names": DOC_BLOCKS + f"SELECT block_id, {file_name(SHARD)} AS file FROM blocks",
    "resolve_pad": """
        SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN doc_id % 7 ELSE 256 END AS build_pad,
               CASE WHEN doc_id % 3 <> 0 THEN doc_id % 7 ELSE 257 END AS train_pad FROM documents""",
    "valid_text": """
        SELECT doc_id, CAST(strlen(text) AS INTEGER) AS n_bytes
        FROM (SELECT doc_id, CASE WHEN n_chars % 7 = 0 THEN '' WHEN n_chars % 11 = 0 THEN NULL
                     WHEN n_chars % 13 = 0 THEN '  ' ELSE text END AS text FROM documents)
        WHERE text <> ''""",
    "nonempty_ids": f"""
        SELECT doc_id, CAST(len({WORDS}) AS INTEGER) AS n_ids FROM documents
        WHERE n_chars % 5 <> 0 AND len({WORDS}) > 0""",
    "exact_length": DOC_FRAGMENTS + f"""
        SELECT doc_id, block_id, {digest(ids_of('piece'))} AS digest
        FROM fragments WHERE length(piece) = {2 * SEQ_LEN}""",
    "token_range": DOC_BLOCKS + f"""
        SELECT block_id, max_id >= 200 AS past_200, max_id
        FROM (SELECT block_id, list_max({ids_of('h')}) AS max_id FROM blocks)""",
    "supervised_batches": DOC_FRAGMENTS + """
        SELECT doc_id, block_id, CAST(length(replace(piece, 'ZZ', '')) // 2 AS INTEGER) AS n_labels
        FROM fragments WHERE piece <> 'ZZ'""",
    "finite_guard": LOG + "SELECT run, opt_step, event_id FROM log WHERE isnan(loss) OR isinf(loss)",
    "finite_rows": LOG + "SELECT run, opt_step, loss FROM log WHERE isfinite(loss)",
    "every_n": LOG + "SELECT run, opt_step, micro_step FROM log WHERE opt_step % 10 = 0",
    "progress_rates": LOG + f"""
        SELECT run, opt_step, tokens, dt, tokens / greatest(dt, CAST(1e-9 AS DOUBLE)) AS tok_per_sec,
               (610352 - opt_step) * (dt / CAST(10 AS DOUBLE)) / CAST(3600 AS DOUBLE) AS eta_hours
        FROM (SELECT run, opt_step,
                     epoch_us(ts) / CAST(1000000 AS DOUBLE)
                       - lag(epoch_us(ts)) OVER w / CAST(1000000 AS DOUBLE) AS dt,
                     (micro_step - lag(micro_step) OVER w) * {4 * SEQ_LEN} AS tokens
              FROM log WINDOW w AS (PARTITION BY run ORDER BY opt_step))""",
    "progress_from_start": LOG + f"""
        SELECT run, opt_step, tokens, dt, tokens / greatest(dt, CAST(1e-9 AS DOUBLE)) AS tok_per_sec,
               (610352 - opt_step) * (dt / CAST(10 AS DOUBLE)) / CAST(3600 AS DOUBLE) AS eta_hours
        FROM (SELECT run, opt_step, line,
                     epoch_us(ts) / CAST(1000000 AS DOUBLE)
                       - lag(epoch_us(ts)) OVER w / CAST(1000000 AS DOUBLE) AS dt,
                     (micro_step - lag(micro_step) OVER w) * {4 * SEQ_LEN} AS tokens
              FROM (SELECT run, opt_step, ts, micro_step, 1 AS line FROM log
                    UNION ALL SELECT run, NULL, ts - INTERVAL 7 SECONDS, micro_step - 5, 0
                    FROM log WHERE event_id % 23 = 0)
              WINDOW w AS (PARTITION BY run ORDER BY ts, line, opt_step))
        WHERE line = 1""",
    "union_sources": """
        SELECT 'documents' AS source, doc_id, CAST(strlen(text) AS INTEGER) AS n_bytes FROM documents
        UNION ALL SELECT 'benchmark', item_id, CAST(strlen(text) AS INTEGER) FROM benchmark""",
    "attach_spec": chain(CORPUS) + "SELECT source, doc_id, weight FROM corpus",
    "weighted_interleave": chain(CORPUS, STATS) + f"""
        SELECT source, doc_id, CAST(epoch AS INTEGER) AS epoch,
               (epoch + {unit('source', 'epoch', 'doc_id')}) * n_records / weight AS arrival
        FROM corpus JOIN stats USING (source, weight), range(0, 2) e(epoch)""",
    "token_caps": chain(*CAPPED) + f"""
        SELECT source, doc_id, off, (off + len) // {SEQ_LEN} - off // {SEQ_LEN} AS n_blocks FROM spans""",
    "source_available": chain(*CAPPED) + """
        SELECT source, count(*) AS n_docs, CAST(sum(len) AS BIGINT) AS tokens FROM spans GROUP BY source""",
    "repeat_epochs": chain(CORPUS, STATS, TOTAL, *placed(2), *spans()) + f"""
        SELECT source, CAST(epoch AS INTEGER) AS epoch, doc_id, off FROM spans, total
        WHERE off < {BUDGET} * {SEQ_LEN}""",
    "seeded_shuffle": f"""
        SELECT source, doc_id, CAST(row_number() OVER (
            PARTITION BY source ORDER BY {unit('source', '0', 'doc_id')}, doc_id) - 1 AS BIGINT) AS pos
        FROM documents""",
    "weighted_choice": f"""
        SELECT doc_id, CASE WHEN draw <= 5.0 THEN 'documents' WHEN draw <= 7.0 THEN 'conversations'
                            WHEN draw <= 8.5 THEN 'pages' ELSE 'benchmark' END AS choice
        FROM (SELECT doc_id, {unit('doc_id')} * 9.0::DOUBLE AS draw FROM documents)""",
    "stream_offsets": DOC_SPANS + "SELECT source, doc_id, off, len FROM spans",
    "block_overlap": DOC_FRAGMENTS + "SELECT doc_id, block_id FROM fragments",
    "source_stats": chain(CORPUS, STATS) + """
        SELECT source, n_records, n_docs, tokens, longest, tokens / n_docs AS mean_len FROM stats""",
    "per_source_tokens": DOC_BLOCKS + f"""
        SELECT source, count(*) * {SEQ_LEN} AS tokens FROM blocks GROUP BY source""",
    "mix_report": chain(*CAPPED, FRAGMENTS, BLOCKS) + f""", listed AS (
            SELECT DISTINCT source, weight FROM corpus),
        exact AS (SELECT source, count(*) AS n_docs, CAST(sum(len) AS BIGINT) AS doc_tokens
                  FROM spans GROUP BY source),
        labelled AS (SELECT source, count(*) * {SEQ_LEN} AS label_tokens FROM blocks GROUP BY source)
        SELECT source, n_docs, doc_tokens, coalesce(label_tokens, 0) AS label_tokens,
               weight / sum(weight) OVER () AS wanted_share,
               n_docs / sum(n_docs) OVER () AS doc_share,
               doc_tokens / sum(doc_tokens) OVER () AS token_share,
               coalesce(label_tokens, 0) / sum(coalesce(label_tokens, 0)) OVER () AS label_share,
               coalesce(label_tokens, 0) / cap AS cap_use
        FROM listed LEFT JOIN exact USING (source) LEFT JOIN labelled USING (source)
             LEFT JOIN caps USING (source)""",
    "shard_summary": DOC_SHARDS + "SELECT * FROM shards",
    "pack_blocks": DOC_BLOCKS + f"SELECT block_id, source, n_docs, {DIGEST} AS digest FROM blocks",
    "assemble_blocks": DOC_BLOCKS + f"SELECT block_id, source, n_docs, {DIGEST} AS digest FROM blocks",
    "mixed_corpus": MIXED + f"""
        SELECT block_id, source, n_docs, {DIGEST} AS digest FROM blocks, bound WHERE block_id < n_blocks""",
    "token_extrema": DOC_BLOCKS + f"""
        SELECT {SHARD} AS shard_id, min(list_min({ids_of('h')})) AS min_id,
               max(list_max({ids_of('h')})) AS max_id FROM blocks GROUP BY 1""",
    "mask_stats": MASK_STATS,
    "sorted_shards": strided("file") + "SELECT file, pos FROM lined",
    "shuffled_shards": strided(BY_HASH) + "SELECT file, pos FROM lined",
    "rank_shards": strided(BY_HASH) + "SELECT file, rank, shard_pos FROM ranks",
    "rank_coverage": strided("file") + """
        SELECT file, CASE WHEN rank = 1 THEN CAST(0 AS BIGINT) ELSE 2 END AS ranks
        FROM ranks WHERE rank = 1 OR shard_id = 0""",
    "step_plan": DOC_BLOCKS + f"""
        SELECT count(*) * {SEQ_LEN} AS total_tokens,
               CAST({SEQ_LEN * BATCH * WORLD} AS BIGINT) AS tokens_per_step,
               CAST(ceil(count(*) * {SEQ_LEN} / {SEQ_LEN * BATCH * WORLD}) AS BIGINT) AS steps
        FROM blocks""",
    "micro_batches": batches("file") + f"""
        SELECT rank, batch_id, CAST(n_rows AS INTEGER) AS n_rows, {DIGEST} AS digest,
               CAST(length(replace(h, 'ZZ', '')) // 2 AS INTEGER) AS valid_labels
        FROM batches""",
    "training_rows": strided("file") + f"""
        SELECT rank, shard_pos, block_id,
               {digest(f"list_transform({ids_of('h')}, lambda x: CASE WHEN x <> 256 THEN x ELSE -100 END)")}
                 AS labels_digest,
               {digest(f"list_transform({ids_of('h')}, lambda x: CAST(x <> 256 AS INTEGER))")} AS mask_digest
        FROM blocks JOIN ranks ON {SHARD} = shard_id""",
    "read_batches": batches(BY_HASH) + f"SELECT rank, batch_id, {DIGEST} AS digest FROM batches",
    "read_published": batches(BY_HASH) + f"SELECT rank, batch_id, {DIGEST} AS digest FROM batches",
    "assign_shards": DOC_BLOCKS + f"SELECT block_id, {SHARD} AS shard_id, source FROM blocks",
    "budget_cut": DOC_BLOCKS + f"""
        SELECT block_id, source FROM blocks, total
        WHERE block_id < (tokens // 2 + {SEQ_LEN - 1}) // {SEQ_LEN}""",
    "head_blocks": DOC_BLOCKS + f"""
        SELECT block_id, source, {DIGEST} AS digest FROM blocks, total
        WHERE block_id < tokens // {SEQ_LEN} // 10""",
    "stream_rows": MASK_STATS,
    "pack_stream": STREAM + f"""
        SELECT source, lane, n_blocks, n_blocks - 1 AS last_seq, n_blocks * {SEQ_LEN} AS tokens
        FROM lanes WHERE n_blocks > 0""",
    "pack_stream_lanes": STREAM_LANES + f"""
        SELECT source, lane, n_blocks, n_blocks - 1 AS last_seq, n_blocks * {SEQ_LEN} AS tokens
        FROM lanes WHERE n_blocks > 0""",
    "progress_stream": STREAM + f"""
        SELECT CAST(sum(n_blocks) AS BIGINT) AS stored_blocks, CAST(sum(n_blocks) AS BIGINT) AS seen_blocks,
               CAST(sum(n_blocks) * {SEQ_LEN} AS BIGINT) AS seen_tokens FROM lanes""",
    "resume": MIXED + f""", half AS (SELECT {HALF} AS n_half FROM total)
        SELECT block_id, source, CAST(CASE WHEN block_id < n_half THEN block_id // {BLOCKS_PER_SHARD}
                   ELSE (n_half + {BLOCKS_PER_SHARD - 1}) // {BLOCKS_PER_SHARD}
                        + (block_id - n_half) // {BLOCKS_PER_SHARD} END AS INTEGER) AS shard_id,
               {DIGEST} AS digest
        FROM blocks, bound, half WHERE block_id < n_blocks""",
}
