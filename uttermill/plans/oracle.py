"""The catalogue's queries as SQL for DuckDB, over the same tables.

Edit distance there counts bytes.  The tables hold 21 letters outside ASCII;
mapping each to a control character of its own keeps every distance and makes
bytes and characters the same.
"""

from __future__ import annotations

_LETTERS = "éóèñçüêäößíÉÈÑÓÇÄÊÜÖÍ"
_CONTROL = [*range(1, 9), 11, 12, *range(14, 25)]


def _ascii(expr: str) -> str:
    codes = "||".join(f"chr({i})" for i in _CONTROL)
    return f"translate({expr}, '{_LETTERS}', {codes})"


def _edits(a: str, b: str) -> str:
    return f"CAST(levenshtein({_ascii(a)}, {_ascii(b)}) AS BIGINT)"


def _normalize(expr: str) -> str:
    s = f"replace(replace({expr}, '[UNK]', ''), '[PAD]', '')"
    s = f"regexp_replace({s}, '[。々-〇【】！，：？￤￩]', '', 'g')"
    s = rf"regexp_replace({s}, '[!-/:-@\[-`{{-~]', '', 'g')"
    s = f"regexp_replace({s}, '[、：；？！]', '', 'g')"
    s = rf"regexp_replace({s}, '[,?.!\-;:\"“%‘”�''»«]', '', 'g')"
    return f"replace(lower({s}), ' ', '')"


def _vocab_clean(expr: str, lower: bool = True) -> str:
    s = rf"regexp_replace({expr}, '[,?.!\-;:\"“%‘”�''»«]', '', 'g')"
    s = f"lower({s})" if lower else s
    return f"regexp_replace({s}, '[。々-〇【】，：？￤￩]', '', 'g')"


def _basic(expr: str, wide: str = "", plain: str = "") -> str:
    s = rf"regexp_replace(lower({expr}), '[<\[][^>\]]*[>\]]', '', 'g')"
    s = rf"regexp_replace({s}, '\([^)]+?\)', '', 'g')"
    s = f"translate({s}, '{wide}', '{plain}')" if wide else s
    s = rf"lower(regexp_replace({s}, '[\p{{M}}\p{{S}}\p{{P}}]', ' ', 'g'))"
    return rf"regexp_replace({s}, '\s+', ' ', 'g')"


def _strip(expr: str) -> str:
    return rf"regexp_replace({expr}, '^\s+|\s+$', '', 'g')"


def _chars(expr: str) -> str:
    return f"regexp_extract_all({expr}, '(?s).')"


def _uniform(*parts: str) -> str:
    key = " || ':' || ".join(parts)
    return f"(CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


_U = """SELECT doc_id AS utt_id, source AS corpus, lang AS split, text AS sentence,
    CAST(n_chars AS DOUBLE) / 64 AS input_length FROM documents"""

_MARKED = f"""SELECT utt_id, chr(12288) || chr(9) || translate(replace(sentence, 'th', '[UNK]'), 'qxzjkwv',
    '。“Ａ' || chr(9) || '々！；') || chr(12288) || ' ' || chr(10) AS sentence FROM ({_U}) u"""

_ADMITTED = f"""SELECT utt_id, input_length, CASE WHEN length({_strip('sentence')}) <= 3 THEN 'short text'
    WHEN input_length >= 30 THEN 'too long' WHEN length(sentence) >= 448 THEN 'too many tokens'
    WHEN l.toxic IS DISTINCT FROM 0 THEN 'toxic or unknown'
    WHEN l.quality IS DISTINCT FROM 1 THEN 'low quality' ELSE 'admitted' END AS reason
    FROM ({_U}) u LEFT JOIN labels l ON l.doc_id = u.utt_id"""

_SPOKEN = "SELECT conv_id || '/' || turn AS file_id, role, text AS ref FROM conversations"

_P = f"""SELECT file_id, role, ref, m AS model,
    CASE WHEN CAST(('0x' || substr(md5('hole:' || file_id), 1, 8)) AS BIGINT) % 3 = 0 THEN '' WHEN m = 0 THEN ref WHEN m = 1 THEN reverse(ref)
         ELSE replace(ref, 'e', '') END AS pred
    FROM ({_SPOKEN}) s, (VALUES (0), (1), (2)) k(m) WHERE role <> 'system'"""

_C = """SELECT a.conv_id, a.turn, a.role, a.text AS ref, b.text AS pred
    FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1"""

_AUDIO = "SELECT '/data/audio/' || source || '/' || doc_id || '.wav' AS path FROM documents"


def _texts(folder: str, where: str) -> str:
    return f"""SELECT '/data/{folder}/' || source || '/' || doc_id || '.txt' AS path, text
        FROM documents WHERE {where}"""


_LABELLED = "doc_id IN (SELECT doc_id FROM labels)"
_GOOD = "doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)"


def _key(folder: str) -> str:
    return f"replace(replace(path, 'audio', '{folder}'), '.wav', '.txt')"


_KEYS = f"""SELECT doc_id, source AS corpus, CAST({_LABELLED} AS INT) AS matched FROM documents"""


def _shards(by: str, n: int) -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f"""
    WITH k AS (SELECT *, row_number() OVER ({part} ORDER BY doc_id) - 1 AS row_idx FROM ({_KEYS}) d),
    f AS (SELECT *, coalesce(sum(CASE WHEN matched = 1 AND row_idx > 0 AND row_idx % {n} = 0 THEN 1 ELSE 0 END)
            OVER ({part} ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM k)
    SELECT *, CAST(1 + b AS BIGINT) AS shard FROM f WHERE matched = 1"""


_FREQ = f"""SELECT ch, count(*) AS n FROM (
    SELECT unnest({_chars(_vocab_clean('text'))}) AS ch FROM documents UNION ALL
    SELECT unnest({_chars(_vocab_clean('text', False))}) AS ch FROM benchmark) x GROUP BY ch"""

_VOCAB = f"""
    kept AS (SELECT ch FROM ({_FREQ}) f WHERE n > 15 AND ch <> '|' UNION SELECT ' '),
    ids AS (SELECT ch AS raw, row_number() OVER (ORDER BY ch) - 1 AS id FROM kept),
    vocab AS (SELECT CASE WHEN raw = ' ' THEN '|' ELSE raw END AS ch, id FROM ids
        UNION ALL SELECT '[UNK]', (SELECT count(*) FROM ids)
        UNION ALL SELECT '[PAD]', (SELECT count(*) + 1 FROM ids))"""

_ENCODED = f"""
    WITH {_VOCAB},
    c AS (SELECT conv_id, turn, unnest({_chars('text')}) AS ch,
            generate_subscripts({_chars('text')}, 1) AS pos FROM conversations),
    e AS (SELECT c.*, v.id, v.ch AS known FROM c LEFT JOIN vocab v
            ON v.ch = CASE WHEN c.ch = ' ' THEN '|' ELSE c.ch END)"""


def _shuffled(prefix: str, name: str) -> str:
    return f"""SELECT doc_id AS utt_id,
        row_number() OVER (ORDER BY md5('{prefix}:' || doc_id), doc_id) - 1 AS {name} FROM documents"""


_COPIES = """SELECT vec_id AS utt_id, embedding, r AS replica FROM embeddings, range(0, {k}) t(r)"""


def _draw(*purpose: str) -> str:
    return _uniform("'0'", "utt_id", "replica", *[f"'{p}'" for p in purpose])


def _masked(purpose: str, flag: str) -> str:
    return f"""CASE WHEN {flag} THEN CAST(floor(greatest({purpose}_s, 0.0)) AS BIGINT) END AS {purpose}_start,
        CASE WHEN {flag} THEN CAST(floor(greatest({purpose}_s, 0.0)) + floor({purpose}_w) AS BIGINT) END AS {purpose}_stop"""


_AUGMENTED = f"""
    WITH r AS ({_COPIES.format(k=2)}),
    d AS (SELECT *, {_draw('gate')} AS gate, {_draw('draw')} AS draw,
        {_draw('time', 'width')} * 25 AS time_w, {_draw('freq', 'width')} * 25 AS freq_w FROM r),
    p AS (SELECT *, gate < 0.5 AND draw < 0.3 AS tm, gate < 0.5 AND draw > 0.2 AS st,
        gate < 0.5 AND draw > 0.3 AND draw < 0.7 AS fm,
        {_draw('time', 'start')} * (64 - time_w) AS time_s,
        {_draw('freq', 'start')} * (64 - freq_w) AS freq_s FROM d),
    m AS (SELECT *, {_masked('time', 'tm')}, {_masked('freq', 'fm')} FROM p),
    e AS (SELECT utt_id, replica, unnest(embedding)::DOUBLE AS x,
        generate_subscripts(embedding, 1) - 1 AS i, time_start, time_stop, freq_start, freq_stop FROM m),
    s AS (SELECT utt_id, replica, sum(CASE
        WHEN coalesce(i >= time_start AND i < time_stop, false) THEN 0
        WHEN coalesce(i >= freq_start AND i < freq_stop, false) THEN 0 ELSE x END) AS total
        FROM e GROUP BY ALL)
    SELECT m.utt_id, m.replica, tm::INT AS time_mask, st::INT AS stretch, fm::INT AS freq_mask,
        time_start, time_stop, freq_start, freq_stop, round(s.total, 3) AS total
    FROM m JOIN s USING (utt_id, replica)"""

_MATRICES = f"""
    WITH r AS ({_COPIES.format(k=2)}),
    d AS (SELECT *, {_draw('time', 'width')} * 6 AS tw, {_draw('freq', 'width')} * 6 AS fw FROM r),
    p AS (SELECT *, floor(greatest({_draw('time', 'start')} * ((len(embedding) + 7) // 8 - tw), 0)) AS ts,
        floor(greatest({_draw('freq', 'start')} * (least(len(embedding), 8) - fw), 0)) AS fs FROM d),
    e AS (SELECT utt_id, replica, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i, ts, tw, fs, fw FROM p),
    m AS (SELECT utt_id, replica, CASE WHEN (i // 8 >= ts AND i // 8 < ts + floor(tw)) OR (i % 8 >= fs AND i % 8 < fs + floor(fw))
        THEN 0 ELSE x END AS y FROM e)
    SELECT utt_id, replica, round(sum(y), 3) AS total, count(*) FILTER (y = 0) AS zeros FROM m GROUP BY utt_id, replica"""

_NOISE = f"""
    WITH r AS ({_COPIES.format(k=3)}),
    d AS (SELECT *, CASE WHEN {_draw('noise')} < 0.3
        THEN 0.001 + {_draw('amp')} * (0.015 - 0.001) END AS noise_amp FROM r),
    e AS (SELECT utt_id, replica, noise_amp, unnest(embedding) AS x,
        generate_subscripts(embedding, 1) - 1 AS i FROM d),
    g AS (SELECT *, md5('0:' || utt_id || ':' || replica || ':' || (i // 4)) AS h, (i % 4) // 2 * 16 AS o FROM e),
    b AS (SELECT *, CAST('0x' || substr(h, 1 + o, 8) AS BIGINT) AS u, CAST('0x' || substr(h, 9 + o, 8) AS BIGINT) AS v FROM g),
    c AS (SELECT *, sqrt(-2.0 * ln((u + 1) / 4294967297.0::DOUBLE)) AS r, 6.283185307179586 * (v / 4294967296.0::DOUBLE) AS w FROM b),
    n AS (SELECT *, r * CASE WHEN i % 2 = 0 THEN cos(w) ELSE sin(w) END AS z FROM c)
    SELECT utt_id, replica, round(any_value(noise_amp), 8) AS noise_amp,
        round(sum(coalesce((x + noise_amp * z)::FLOAT, x)::DOUBLE), 3) AS total
    FROM n GROUP BY utt_id, replica"""

_RTF = """SELECT user_id AS model, value AS gen_time,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) + 1 AS seconds FROM events"""

_REPORT = f"""SELECT file_id, model, ref AS target, pred, {_normalize('ref')} AS norm_target,
    {_normalize('pred')} AS norm_pred FROM ({_P}) p"""

_RELABEL = f"""SELECT *, {_basic('ref')} AS nr, {_basic('pred')} AS np FROM ({_P}) p"""

ORACLE: dict[str, str] = {
    "normalize_transcripts": f"SELECT utt_id, {_normalize('sentence')} AS sentence FROM ({_U}) u",
    "normalize_vocab_text": rf"""SELECT utt_id, {_vocab_clean('sentence')} AS lowered,
        {_vocab_clean('sentence', False)} AS cased,
        regexp_replace(lower(sentence), '[!-&(-/:-@\[-`{{-~]', '', 'g') AS switched FROM ({_U}) u""",
    "normalize_basic": f"SELECT utt_id, {_basic('sentence')} AS sentence FROM ({_U}) u",
    "normalize_marked": f"""SELECT utt_id, {_normalize('sentence')} AS normalized, {_vocab_clean('sentence')} AS lowered,
        {_basic('sentence', 'ａ　', 'a ')} AS basic,
        trim(sentence, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(12288)) AS stripped FROM ({_MARKED}) m""",
    "strip_length_filter": f"""SELECT utt_id, length(s) AS n_chars, CAST(length(s) > 3 AS INT) AS corpus_ok,
        CAST(length(s) > 5 AS INT) AS pseudo_ok
        FROM (SELECT utt_id, {_strip('sentence')} AS s FROM ({_U}) u) x WHERE length(s) > 1""",
    "rewrite_urls": """SELECT page_id, replace(replace(replace(url, 'e', 'E'), 'http://', 's3a://'), '.com', '.txt') AS path,
        regexp_extract(url, '[^/]*$') AS name FROM pages""",
    "markup_filter": """SELECT page_id, CAST(regexp_matches(url, '<[^>]*>') AS INT) AS url_markup,
        CAST(regexp_matches(html, '<[^>]*>') AS INT) AS html_markup FROM pages""",
    "parse_id_list": """SELECT vec_id, len(embedding) AS n_ids,
        array_to_string(list_transform(embedding, lambda x: CAST(floor(abs(x::DOUBLE) * 1000) AS INT)), ' ') AS ids,
        1 AS plain_is_text FROM embeddings""",
    "duration_filters": f"""SELECT utt_id, input_length, CAST(input_length < 29.5 AS INT) AS prefilter_ok,
        CAST(input_length > 1.5 AND input_length < 30 AS INT) AS band_ok FROM ({_U}) u WHERE input_length < 30""",
    "sample_duration": """SELECT label, count(*) AS n_rows, sum(len(embedding) / 16.0::DOUBLE) AS total_seconds
        FROM embeddings GROUP BY label""",
    "label_filters": f"""SELECT utt_id, length(sentence) AS n_tokens, CAST(length(sentence) < 448 AS INT) AS below_max,
        CAST(length(sentence) BETWEEN 1 AND 128 AS INT) AS band_ok,
        CAST(length(sentence) > 5 AND length(sentence) < 450 AS INT) AS chars_ok,
        substr(sentence, 1, 128) AS truncated FROM ({_U}) u""",
    "filter_funnel": f"""SELECT corpus, count(*) AS n_input, count(*) FILTER (t) AS n_text,
        count(*) FILTER (t AND d) AS n_duration, count(*) FILTER (t AND d AND l) AS n_label
        FROM (SELECT corpus, length({_strip('sentence')}) > 3 AS t, input_length < 29.5 AS d,
            length(sentence) > 5 AND length(sentence) < 1500 AS l FROM ({_U}) u) x GROUP BY corpus""",
    "shape_filter": "SELECT vec_id, 0 AS model_shape FROM embeddings WHERE len(embedding) = 64",
    "media_signature": """SELECT page_id, CAST(html LIKE '<!%' OR html LIKE '<h%' AS INT) AS is_page,
        0 AS is_audio FROM pages""",
    "media_headers": "SELECT page_id, CAST(page_id % 13 IN (0, 1, 3, 4, 12) AS INT) AS is_audio FROM pages",
    "admission_split": f"SELECT utt_id, CASE WHEN reason = 'admitted' THEN '' ELSE reason END AS reason FROM ({_ADMITTED}) x",
    "admission_report": f"""SELECT reason, count(*) AS n_rows, round(sum(input_length), 4) AS seconds
        FROM ({_ADMITTED}) x GROUP BY reason""",
    "pair_strict": f"""SELECT a.path, t.text AS transcript FROM ({_AUDIO}) a
        LEFT JOIN ({_texts('clean', 'true')}) t ON t.path = {_key('clean').replace('path', 'a.path')}""",
    "pair_skip": f"""SELECT a.path, t.text AS transcript FROM ({_AUDIO}) a
        JOIN ({_texts('clean', _LABELLED)}) t ON t.path = {_key('clean').replace('path', 'a.path')}""",
    "pair_fallback": f"""SELECT a.path, coalesce('first: ' || f.text, s.text) AS transcript FROM ({_AUDIO}) a
        LEFT JOIN ({_texts('common', _GOOD)}) f ON f.path = {_key('common').replace('path', 'a.path')}
        LEFT JOIN ({_texts('clean', _LABELLED)}) s ON s.path = {_key('clean').replace('path', 'a.path')}
        WHERE f.path IS NOT NULL OR s.path IS NOT NULL""",
    "pair_missing": f"""SELECT path FROM ({_AUDIO}) a
        WHERE {_key('clean')} NOT IN (SELECT path FROM ({_texts('clean', _LABELLED)}) t)""",
    "pair_present": f"""SELECT path FROM ({_AUDIO}) a
        WHERE {_key('clean')} IN (SELECT path FROM ({_texts('clean', _LABELLED)}) t)""",
    "annotation_join": """SELECT e.event_id, e.field, e.key, d.path, d.n_chars FROM (
        SELECT event_id, field, json_extract_string(props, '$.' || field) AS key
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS field FROM events) x) e
        JOIN (SELECT 'wavs/' || doc_id || '.wav' AS path, n_chars FROM documents) d
        ON d.path = 'wavs/' || e.key || '.wav'""",
    "attach_predictions": f"""SELECT s.file_id, s.role, p.pred AS transcript FROM ({_SPOKEN}) s
        JOIN ({_P}) p ON p.file_id = s.file_id AND p.model = 2 WHERE p.pred <> ''""",
    "attach_predictions_default": f"""SELECT s.file_id, s.role, coalesce(p.pred, '') AS transcript,
        CAST(coalesce(p.pred, '') = '' AS INT) AS is_blank FROM ({_SPOKEN}) s
        LEFT JOIN ({_P}) p ON p.file_id = s.file_id AND p.model = 2""",
    "map_lookup": """SELECT event_id, coalesce(json_extract_string(props, '$.k'), '') AS k,
        coalesce(json_extract_string(props, '$.absent'), '') AS absent FROM events""",
    "attach_positional": """SELECT a.row_idx, a.doc_id, b.other_id, b.value FROM
        (SELECT row_number() OVER (ORDER BY source, doc_id) - 1 AS row_idx, doc_id FROM documents) a JOIN
        (SELECT row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS row_idx, doc_id AS other_id,
            n_chars AS value FROM documents) b USING (row_idx)""",
    "corpus_totals": f"""SELECT corpus, count(*) AS n_rows, sum(input_length) AS total_seconds
        FROM ({_U}) u GROUP BY corpus""",
    "rtf_by_model": f"""SELECT model, count(*) AS n_samples, round(sum(gen_time), 4) AS gen_seconds,
        round(sum(seconds), 4) AS audio_seconds, round(sum(gen_time) / sum(seconds), 6) AS rtf
        FROM ({_RTF}) v GROUP BY model""",
    "cer_by_utterance": f"""SELECT conv_id, turn, length(r) AS ref_chars,
        CASE WHEN length(r) > 0 THEN {_edits('r', 'p')} END AS edits,
        CASE WHEN length(r) > 0 THEN round({_edits('r', 'p')} / length(r), 6) END AS cer
        FROM (SELECT conv_id, turn, {_normalize('ref')} AS r, {_normalize('pred')} AS p FROM ({_C}) c) x""",
    "cer_corpus": f"""SELECT role, count(*) AS n_rows, count(*) FILTER (length(r) > 0) AS n_scored,
        CAST(sum(ne) AS BIGINT) AS edits, CAST(sum(length(r)) AS BIGINT) AS ref_chars,
        round(100 * sum(ne) / sum(length(r)), 2) AS cer, round(100 * sum(re) / sum(length(ref)), 2) AS cer_ortho
        FROM (SELECT *, CASE WHEN length(r) > 0 THEN {_edits('r', 'p')} END AS ne,
            CASE WHEN length(ref) > 0 THEN {_edits('ref', 'pred')} END AS re
            FROM (SELECT role, ref, pred, {_normalize('ref')} AS r, {_normalize('pred')} AS p FROM ({_C}) c) x) y
        GROUP BY role""",
    "cer_by_model": f"""SELECT CAST(model AS BIGINT) AS model, role, count(*) AS n_samples,
        CAST(sum(ne) AS BIGINT) AS edits, CAST(sum(length(r)) AS BIGINT) AS ref_chars,
        round(100 * sum(ne) / sum(length(r)), 2) AS cer,
        round(sum(length(pred) / 64.0::DOUBLE) / sum(length(ref) / 16.0::DOUBLE), 6) AS rtf
        FROM (SELECT *, CASE WHEN length(r) > 0 THEN {_edits('r', 'p')} END AS ne
            FROM (SELECT model, role, ref, pred, {_normalize('ref')} AS r, {_normalize('pred')} AS p FROM ({_P}) c) x) y
        GROUP BY model, role""",
    "cer_relabel": f"""SELECT file_id, CAST(model AS BIGINT) AS model, CAST(near AS INT) AS relabelled,
        CASE WHEN near THEN pred ELSE ref END AS label
        FROM (SELECT *, length(nr) > 0 AND 100 * {_edits('nr', 'np')} / length(nr) < 15 AS near
            FROM ({_RELABEL}) r) x""",
    "error_report": f"""SELECT z.* REPLACE (CAST(model AS BIGINT) AS model) FROM ({_REPORT}) z
        WHERE length(norm_target) > 0 AND norm_target <> norm_pred""",
    "first_rows": f"""SELECT z.* EXCLUDE (model) FROM ({_REPORT}) z
        WHERE model = 2 AND length(norm_target) > 0 ORDER BY file_id LIMIT 100""",
    "char_frequency": f"""SELECT lang, ch, count(*) AS n
        FROM (SELECT lang, unnest({_chars('text')}) AS ch FROM documents) x GROUP BY lang, ch""",
    "char_union": f"""SELECT ch, CAST(ord(ch) AS BIGINT) AS code FROM (
        SELECT unnest({_chars('text')}) AS ch FROM documents UNION
        SELECT unnest({_chars('text')}) FROM conversations UNION
        SELECT unnest({_chars('text')}) FROM benchmark) x""",
    "build_vocab": f"WITH {_VOCAB} SELECT ch, CAST(id AS BIGINT) AS id FROM vocab",
    "encode_chars": f"""{_ENCODED} SELECT conv_id, turn,
        string_agg(coalesce(id, (SELECT id FROM vocab WHERE ch = '[UNK]'))::VARCHAR, ' ' ORDER BY pos) AS ids
        FROM e GROUP BY conv_id, turn""",
    "decode_chars": f"""{_ENCODED} SELECT conv_id, turn,
        string_agg(CASE WHEN known = '|' THEN ' ' ELSE coalesce(known, '') END, '' ORDER BY pos) AS text
        FROM e GROUP BY conv_id, turn""",
    "concat_text": """SELECT chunk, count(*) AS n_rows, md5(string_agg(text, '' ORDER BY row_idx)) AS digest FROM (
        SELECT text, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx,
            (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS chunk FROM documents) x GROUP BY chunk""",
    "mean_batch_metric": """SELECT count(*) AS n_batches, round(avg(v), 4) AS mean_value FROM (
        SELECT event_id // 64 AS batch, avg(value) AS v FROM events GROUP BY 1) x""",
    "masked_divergence": """
        WITH t AS (SELECT label - 3 AS label, list_transform(embedding::DOUBLE[], lambda v: v / 2) AS a,
            list_transform(list_concat(embedding[2:], embedding[1:1])::DOUBLE[], lambda v: v / 2) AS b FROM embeddings),
        x AS (SELECT label, list_transform(a, lambda v: exp(v - list_max(a))) AS p,
            list_transform(b, lambda v: exp(v - list_max(b))) AS q FROM t),
        y AS (SELECT label, list_transform(p, lambda v: v / list_sum(p)) AS p,
            list_transform(q, lambda v: v / list_sum(q)) AS q FROM x),
        z AS (SELECT label, list_sum(list_transform(list_zip(p, q), lambda s: s[1] * (ln(s[1]) - ln(s[2])))) AS d FROM y),
        r AS (SELECT count(*) FILTER (label >= 0) AS n, sum(d) FILTER (label >= 0) AS s FROM z)
        SELECT n AS n_positions, round(s / n, 6) AS divergence,
            round(0.8::DOUBLE * 1.5::DOUBLE + s / n * 4, 6) AS loss FROM r""",
    "concat_corpora": f"""SELECT 'documents' AS corpus, utt_id::VARCHAR AS utt_id, split, input_length,
            length(sentence) AS n_chars FROM ({_U}) u
        UNION ALL SELECT 'conversations', file_id, role, NULL, length(ref) FROM ({_SPOKEN}) s
        UNION ALL SELECT 'benchmark', item_id::VARCHAR, NULL, NULL, length(text) FROM benchmark""",
    "combine_corpora": f"""SELECT 'documents' AS corpus, lang AS config, 'train' AS split,
            doc_id::VARCHAR AS utt_id, text AS sentence FROM documents WHERE lang IN ('en', 'fr')
        UNION ALL SELECT 'turns', 'all', role, file_id, ref FROM ({_SPOKEN}) s WHERE role = 'user'""",
    "mix_corpora": f"""SELECT utt_id, split, corpus FROM ({_U}) u
        WHERE {_uniform("'7'", 'utt_id')} < CASE split WHEN 'en' THEN 0.25 WHEN 'fr' THEN 0.5
            WHEN 'de' THEN 0.75 WHEN 'es' THEN 1.0 END""",
    "mix_weighted": f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY corpus
            ORDER BY md5('7:' || utt_id), utt_id) - 1 AS rank, CASE corpus WHEN 'src0' THEN 0.3::DOUBLE ELSE 0.7::DOUBLE END AS share
            FROM ({_U}) u WHERE corpus IN ('src0', 'src1')),
        t AS (SELECT min(floor(n / share + 1e-9)) AS size FROM (SELECT count(*) AS n, share FROM k GROUP BY share) c)
        SELECT utt_id, corpus FROM k, t WHERE rank < floor(size * share + 1e-9)""",
    "retain_newest_by_quality": """SELECT quality AS run, doc_id AS step,
        CAST(row_number() OVER (PARTITION BY quality ORDER BY doc_id DESC) <= 50 AS INT) AS kept
        FROM documents LEFT JOIN labels USING (doc_id)""",
    "cast_and_check": """SELECT event_id, ts::DATE::VARCHAR AS day, CAST(floor(value) AS BIGINT) AS whole,
        value::FLOAT::DOUBLE AS single FROM events""",
    "replicate_augment": _AUGMENTED,
    "add_noise": _NOISE,
    "mask_matrices": _MATRICES,
    "retain_newest_ties": """SELECT user_id AS run, hour(ts) AS step, event_type, CAST(row_number() OVER
        (PARTITION BY user_id ORDER BY hour(ts) DESC, event_type DESC) <= 2 AS INT) AS kept FROM events""",
    "collate_batches": """SELECT row_idx // 64 AS batch, arg_min(conv_id, row_idx) AS first_conv, count(*) AS n_rows, max(n) AS width,
        CAST(count(*) * max(n) - sum(n) AS BIGINT) AS n_pad FROM (SELECT conv_id, length(text) AS n,
        row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_idx FROM conversations) t GROUP BY 1""",
    "concat_text_bytes": """SELECT lang, b // 50000 AS chunk, count(*) AS n_rows, md5(string_agg(text, '' ORDER BY doc_id)) AS digest FROM (
        SELECT *, CAST(coalesce(sum(strlen(text)) OVER (PARTITION BY lang ORDER BY doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b FROM documents) x GROUP BY lang, chunk""",
    "frame_stats": """SELECT label, count(*) AS n_frames, round(avg(e), 6) AS mean_energy,
        round(stddev_samp(e), 6) AS std_energy FROM (
            SELECT label, list_sum(list_transform(embedding[k * 8 + 1 : k * 8 + 16],
                lambda x: x::DOUBLE * x::DOUBLE)) / 16 AS e FROM embeddings, range(0, 7) t(k)) f GROUP BY label""",
    "assign_shards": f"""SELECT s.doc_id, s.row_idx, s.shard FROM ({_shards('', 50)}) s
        JOIN documents d USING (doc_id) WHERE length({_strip('d.text')}) > 5""",
    "assign_shards_by_corpus": f"""SELECT doc_id, corpus, row_idx, shard FROM ({_shards('corpus', 20)}) s""",
    "sharded_files": f"""SELECT shard, count(*) AS n_rows, min(doc_id) AS first_id, max(doc_id) AS last_id,
        1::BIGINT AS n_files FROM ({_shards('', 50)}) s GROUP BY shard""",
    "interleave_splits": """
        WITH r AS (SELECT doc_id AS utt_id, lang AS split,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS turn FROM documents)
        SELECT utt_id, split, turn * 4 + CASE split WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END AS position
        FROM r WHERE turn < (SELECT min(n) FROM (SELECT count(*) AS n FROM r GROUP BY split) c)""",
    "interleave_weighted": """
        WITH w AS (SELECT * FROM (VALUES ('en', 0, 2), ('de', 1, 4), ('fr', 2, 5), ('es', 3, 20)) v(split, o, unit)),
        r AS (SELECT doc_id AS utt_id, split, o, unit, count(*) OVER (PARTITION BY split) AS n,
            row_number() OVER (PARTITION BY split ORDER BY doc_id) - 1 AS turn FROM documents JOIN w ON lang = split),
        e AS (SELECT 'first' AS stop, min((n * unit, o)) AS last FROM r UNION ALL SELECT 'all', max((n * unit, o)) FROM r),
        p AS (SELECT *, unnest(range(CASE stop WHEN 'first' THEN 1 ELSE (SELECT max(n * unit) FROM r) // (n * unit) + 1 END)) AS cycle FROM r, e),
        d AS (SELECT *, ((cycle * n + turn + 1) * unit, o) AS due FROM p)
        SELECT utt_id, split, cycle, stop, row_number() OVER (PARTITION BY stop ORDER BY due) - 1 AS position FROM d WHERE due <= last""",
    "combine_sampled": """
        WITH w AS (SELECT * FROM (VALUES (0, 'src0', 'en', 1), (1, 'src1', 'en', 2), (2, 'src0', 'fr', 6)) v(src, s, l, unit)),
        r AS (SELECT src, doc_id::VARCHAR AS utt_id, text, unit, count(*) OVER (PARTITION BY src) AS n,
            row_number() OVER (PARTITION BY src ORDER BY md5('3:' || src || ':' || doc_id), doc_id::VARCHAR) AS turn
            FROM documents JOIN w ON source = s AND lang = l),
        e AS (SELECT min((n * unit, src)) AS last FROM r),
        d AS (SELECT *, (turn * unit, src) AS due FROM r)
        SELECT src AS source, utt_id, row_number() OVER (ORDER BY due) - 1 AS position, md5(text) AS digest FROM d, e WHERE due <= last""",
    "mix_weighted_shared_keys": """WITH k AS (SELECT doc_id, corpus, share, row_number() OVER (PARTITION BY corpus
            ORDER BY md5('7:' || doc_id), doc_id) - 1 AS rank
            FROM documents, (VALUES ('a', 0.3::DOUBLE), ('b', 0.7::DOUBLE)) v(corpus, share)),
        t AS (SELECT min(floor(n / share + 1e-9)) AS size FROM (SELECT count(*) AS n, share FROM k GROUP BY share) c)
        SELECT doc_id, corpus FROM k, t WHERE rank < floor(size * share + 1e-9)""",
    "assemble_batches": f"""
        WITH t AS (SELECT row_number() OVER (ORDER BY role, conv_id, turn) - 1 AS row_idx,
            CASE WHEN role = 'system' THEN [] ELSE [1] END ||
                list_transform({_chars('text')}, lambda c: ord(c)) AS l FROM conversations),
        b AS (SELECT *, row_idx // 16 AS batch FROM t),
        w AS (SELECT *, max(len(l)) OVER (PARTITION BY batch) AS width,
            bool_and(l[1] = 1) OVER (PARTITION BY batch) AS cut FROM b),
        p AS (SELECT row_idx, batch, cut,
            list_resize(l, width, -100) AS l FROM w),
        c AS (SELECT row_idx, batch, CASE WHEN cut THEN l[2:] ELSE l END AS l FROM p)
        SELECT row_idx, batch, len(l) AS width, md5(array_to_string(l, ' ')) AS digest FROM c""",
    "padding_mask": f"""
        WITH t AS (SELECT conv_id, turn, list_transform({_chars('text')}, lambda c: ord(c)) AS l FROM conversations)
        SELECT conv_id, turn, greatest(len(l), 400) AS width, len(l) AS n_real,
            md5(array_to_string(list_resize(l, greatest(len(l), 400), -100), ' ')) AS digest FROM t""",
    "shift_and_mask": f"""
        WITH t AS (SELECT conv_id, turn, list_transform({_chars('text')}, lambda c: ord(c)) AS l FROM conversations),
        p AS (SELECT *, coalesce(list_position(l, 32), 0) AS pos FROM t),
        m AS (SELECT *, CASE WHEN pos > 1 THEN list_transform(l, lambda x, i: CASE WHEN i <= pos THEN -100 ELSE x END)
            ELSE l END AS k FROM p)
        SELECT conv_id, turn, array_to_string([1] || l[1:len(l) - 1], ' ') AS shifted,
            array_to_string(l[1:len(l) - 1], ' ') AS inputs, array_to_string(k, ' ') AS targets,
            array_to_string(list_transform(k, lambda x: CASE WHEN x = -100 THEN 0 ELSE x END), ' ') AS restored FROM m""",
    "ctc_greedy": """
        WITH f AS (SELECT vec_id, list_transform(range(0, (len(embedding) + 3) // 4), lambda i: embedding[i * 4 + 1 : i * 4 + 4]) AS fr FROM embeddings),
        a AS (SELECT vec_id, list_transform(fr, lambda s: list_position(s, list_max(s)) - 1) AS ids FROM f),
        c AS (SELECT vec_id, ids, list_filter(ids, lambda x, i: x <> 0 AND (i = 1 OR x <> ids[i - 1])) AS col FROM a)
        SELECT vec_id, array_to_string(ids, ' ') AS ids, array_to_string(col, ' ') AS collapsed FROM c""",
    "retain_newest": """SELECT user_id AS run, event_id AS step,
        CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 3 AS INT) AS kept FROM events""",
    "latest_per_group": """SELECT user_id AS run,
        arg_max('checkpoint-' || event_id || '-epoch-' || json_extract_string(props, '$.k'), event_id) AS path,
        max(event_id) AS step FROM events WHERE event_type <> 'error' GROUP BY user_id""",
    "checkpoint_steps": """SELECT event_id, CASE WHEN event_type IS DISTINCT FROM 'error' THEN event_id END AS step
        FROM events""",
    "seeded_shuffle": _shuffled("0", "shuffle_pos"),
    "epoch_shuffle": f"""SELECT utt_id, pos_1, pos_2 FROM ({_shuffled('0:1', 'pos_1')}) a
        JOIN ({_shuffled('0:2', 'pos_2')}) b USING (utt_id)""",
    "resume_skip": f"SELECT * FROM ({_shuffled('0', 'shuffle_pos')}) s WHERE shuffle_pos >= 192",
    "stream_totals": f"""SELECT model, count(*) AS n_samples, round(sum(gen_time), 4) AS gen_seconds,
        round(sum(seconds), 4) AS audio_seconds FROM ({_RTF}) v GROUP BY model""",
    "stream_filter": f"""SELECT doc_id, {_normalize('text')} AS transcription FROM documents
        WHERE length({_strip('text')}) > 3""",
    "stream_resume": f"SELECT doc_id, length(text) AS n_chars FROM documents WHERE length({_strip('text')}) > 3",
    "stream_snapshot": "SELECT event_id::VARCHAR AS file_id, event_type AS transcript FROM events",
    "reuse_fresh": """SELECT state, lang, count(*) AS n FROM documents, (VALUES ('first'), ('same'), ('grown')) v(state)
        WHERE state = 'grown' OR lang <> 'en' GROUP BY state, lang""",
    "resume_rows": f"""SELECT doc_id, length({_normalize('text')}) AS n_chars, CASE WHEN lang IN ('en', 'de') THEN 1 ELSE 2 END AS run
        FROM documents""",
    "pair_bucketed": """SELECT '/data/audio/' || source || '/' || doc_id || '.wav' AS path,
        CASE WHEN quality IS NOT NULL THEN md5(text) END AS digest FROM documents LEFT JOIN labels USING (doc_id)""",
    "sharded_bounded": f"""SELECT shard, b // 20000 AS part, min(row_idx) AS first_row, max(row_idx) AS last_row, count(*) AS n_rows,
        CAST(sum(size) AS BIGINT) AS n_bytes FROM (
        SELECT shard, row_idx, size, CAST(coalesce(sum(size) OVER (PARTITION BY shard ORDER BY row_idx
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b
        FROM (SELECT s.*, strlen(text) AS size FROM ({_shards('', 50)}) s JOIN documents USING (doc_id)) t) u GROUP BY shard, part""",
    "roundtrip_io": f"SELECT file_id, ref AS transcript, ref AS cached FROM ({_SPOKEN}) s",
    "row_index_saved": "SELECT row_number() OVER (ORDER BY source, doc_id DESC) - 1 AS row_idx, doc_id FROM documents",
    "attach_saved": """SELECT row_number() OVER (ORDER BY source, doc_id DESC) - 1 AS row_idx, doc_id, n_chars * 2 AS value
        FROM documents""",
    "transcript_files": """SELECT item_id, strlen(text) + 1 AS length, text,
        row_number() OVER (ORDER BY item_id::VARCHAR || '/') - 1 AS place FROM benchmark""",
    "annotation_files": "SELECT item_id, text AS sentence FROM benchmark",
    "csv_splits": f"""SELECT file_id, md5(regexp_replace(replace(ref, 'th', '"th",'), '([.?])', '\\1' || chr(10) || chr(10) || '""', 'g')) AS digest
        FROM ({_SPOKEN}) s""",
    "csv_skip_first": f"""SELECT file_id, reader FROM ({_SPOKEN}) s, (VALUES ('ranges'), ('files')) v(reader)
        WHERE file_id > (SELECT min(file_id) FROM ({_SPOKEN}) o WHERE o.role = s.role)""",
    "json_splits": "SELECT doc_id, md5(text) AS digest FROM documents",
    "vocab_file": f"WITH {_VOCAB} SELECT ch, CAST(id AS BIGINT) AS id FROM vocab",
    "report_files": f"""
        WITH r AS (SELECT * FROM ({_REPORT}) z WHERE length(norm_target) > 0)
        SELECT file_id, CAST(model AS BIGINT) AS model, 0 AS wrong FROM r UNION ALL
        SELECT file_id, CAST(model AS BIGINT), 1 AS wrong FROM r WHERE norm_target <> norm_pred""",
    "text_blob": r"""SELECT call, chunk, length(t) AS n_chars, md5(t) AS digest
        FROM (VALUES (1::BIGINT), (2::BIGINT)) v(call), (
        SELECT chunk, string_agg(text, '' ORDER BY row_idx) AS t FROM (
            SELECT text, row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_idx,
                (row_number() OVER (ORDER BY conv_id, turn) - 1) // 100 AS chunk FROM conversations) x
        GROUP BY chunk) y""",
    "batch_scorer": f"SELECT file_id, reverse(ref) AS pred, 1 AS timed FROM ({_SPOKEN}) s WHERE length(ref) > 100",
    "map_batches": "SELECT event_id, value * 2 AS value FROM events",
    "job_training_table": f"""SELECT '/data/audio/' || source || '/' || doc_id || '.wav' AS path,
        CAST(n_chars AS DOUBLE) / 64 AS input_length, text AS transcript, r AS replica
        FROM documents, range(0, 3) t(r) WHERE {_LABELLED} AND n_chars / 64.0 < 29.5
            AND length({_strip('text')}) > 3 AND length(text) < 1500""",
    "job_formal_evaluation": f"""SELECT CAST(model AS BIGINT) AS model, count(*) AS n_rows,
        count(*) FILTER (length(r) > 0) AS n_scored, CAST(sum(ne) AS BIGINT) AS edits,
        CAST(sum(length(r)) AS BIGINT) AS ref_chars, round(100 * sum(ne) / sum(length(r)), 2) AS cer,
        round(100 * sum(re) / sum(length(ref)), 2) AS cer_ortho
        FROM (SELECT *, CASE WHEN length(r) > 0 THEN {_edits('r', 'p')} END AS ne, {_edits('ref', 'pred')} AS re
            FROM (SELECT model, ref, pred, {_normalize('ref')} AS r, {_normalize('pred')} AS p FROM ({_P}) c) x) y
        GROUP BY model""",
    "job_pseudo_labels": f"""
        WITH n AS (SELECT file_id, role, CASE WHEN near THEN pred ELSE ref END AS ref, CAST(near AS INT) AS relabelled
            FROM (SELECT *, length(nr) > 0 AND 100 * {_edits('nr', 'np')} / length(nr) < 15 AS near
                FROM ({_RELABEL}) r WHERE model = 2 AND pred <> '') x),
        k AS (SELECT * FROM n WHERE length(ref) BETWEEN 1 AND 450)
        SELECT *, row_number() OVER (ORDER BY md5('0:' || file_id), file_id) - 1 AS shuffle_pos FROM k""",
}
