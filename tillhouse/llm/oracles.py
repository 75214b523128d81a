"""The same results in SQL, where SQL can express them.

The others are tested against brute force: minimax cuts (3), a model's scores (4, 5), entropy windows (6), token ids (9) and
XXH64 fingerprints (10).
"""

from __future__ import annotations

from tillhouse.llm.chat_format import Template
from tillhouse.llm.quality_rules import CAPITALS, MARKS, RULES, STOP_WORDS, SYMBOLS, Rule

SPACES = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rule(rule: Rule) -> str:
    value = rule.measure if rule.base is None else f"100 * {rule.measure}"
    unit = "" if rule.base is None else f" * {rule.base}"
    bounds = [f"{value} >= {rule.low}{unit}"] if rule.low is not None else []
    bounds += [f"{value} <= {rule.high}{unit}"] if rule.high is not None else []
    return " AND ".join(bounds)


def _count(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"


OP1 = rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    s AS (
        SELECT *, list_filter(string_split_regex(t, '{SPACES}'), lambda x: x <> '') AS w,
               list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
        FROM d
    ),
    g AS (
        SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM s)
    ),
    h AS (
        SELECT r, count(DISTINCT i + k) AS n
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) AS x, (VALUES (0), (1), (2)) AS v(k)
        WHERE x.n > 1 GROUP BY r
    ),
    m AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(l) AS n_lines,
               len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(h.n, 0) AS n_repeat_words,
               len(list_filter(w, lambda x: list_contains([{", ".join(map(_quoted, sorted(set(STOP_WORDS))))}], lower(x))))
                   AS n_stop_words,
               {_count(SYMBOLS)} AS n_symbols, {_count(MARKS)} AS n_marks, {_count(CAPITALS)} AS n_capitals
        FROM s LEFT JOIN h USING (r)
    ),
    j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND {" AND ".join(map(_rule, RULES))} AS kept
    FROM j
"""


def _op2() -> str:
    mark = Template()
    reserved = "|".join(["\\\\", *("".join(f"\\{c}" if c in "<>|[]" else c for c in s) for s in mark.reserved)])
    fixed = len(mark.open) + len(mark.body) + len(mark.close)

    def escaped(name: str) -> str:
        return f"length({name}) + len(regexp_extract_all({name}, '{reserved}'))"

    return f"""
    WITH c AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL
        VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
    ),
    g AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
               coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
               CAST(sum({fixed} + {escaped("role")} + {escaped("text")}) AS BIGINT) AS formatted_chars,
               string_agg(role, ',' ORDER BY turn NULLS FIRST, role, text) AS roles
        FROM c GROUP BY conv_id
    )
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
           formatted_chars, regexp_full_match(roles, '(system,)?user(,assistant,user)*(,assistant)?') AS valid
    FROM g
"""


OP7 = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    q AS (
        SELECT page_id, h, strlen(h) >= 1000 AND page_id IS DISTINCT FROM max(page_id) OVER (PARTITION BY h) AS again,
               max(page_id) OVER (PARTITION BY h) AS keeper
        FROM p
    )
    SELECT page_id, strlen(h) AS payload_bytes, sha1(h) AS payload_digest,
           CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN keeper END AS refers_to
    FROM q
"""


def _words(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return rf"list_filter(string_split_regex({lower}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


OP8 = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
    b AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words("text")} AS w FROM benchmark),
    bw AS (
        SELECT DISTINCT item, least(len(w), 10) AS s, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
    ),
    dw AS (
        SELECT r, s, i, array_to_string(w[i:i + s - 1], ' ') AS win
        FROM (SELECT r, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM d, (SELECT DISTINCT s FROM bw) AS sizes)
    ),
    hit AS (SELECT r, i, s, item FROM dw JOIN bw USING (s, win)),
    places AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + s)) AS p FROM hit) GROUP BY r),
    items AS (
        SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
    )
    SELECT doc_id, len(w) AS n_words, coalesce(places.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""

OP12 = rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    w AS (SELECT *, list_filter(string_split_regex(t, '{SPACES}'), lambda x: x <> '') AS w FROM d),
    m AS (
        SELECT r, part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
               CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
               + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
               + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 4 ELSE 0 END
               + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
               + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS bits
        FROM w LEFT JOIN l USING (doc_id)
    ),
    f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
    o AS (
        SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
        FROM f a, f b, f c, f d, f e
        WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
    ),
    s AS (
        SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS filter, bits[step] AS bit,
               CAST(coalesce(list_sum(bits[:step - 1]), 0) AS INTEGER) AS before
        FROM o, (SELECT unnest(range(1, 6)) AS step)
    ),
    a AS (
        SELECT part, filter_order, step, filter,
               count(*) FILTER (bits & (before | bit) = 0) AS kept,
               count(*) FILTER (bits & bit <> 0 AND bits & before = 0) AS removed,
               count(*) FILTER (bits & bit <> 0 AND bits & before <> 0) AS redundant,
               count(*) FILTER (bits = bit) AS unique_fails,
               count(*) FILTER (bits & bit <> 0 AND bits & before = 0 AND good) AS good_lost,
               count(*) FILTER (bits & bit <> 0 AND bits & before = 0 AND toxic) AS toxic_lost
        FROM m, s GROUP BY ALL
    )
    SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley FROM a
"""

OP13 = rf"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t
        FROM documents
    ),
    p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?
-]')) AS piece FROM d),
    w AS (SELECT lang, list_filter(string_split_regex(piece, '[ 	]+'), lambda x: x <> '') AS w FROM p),
    g AS (
        SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
        FROM (
            SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
            FROM w, (SELECT unnest(range(1, 6)) AS size) WHERE len(w) >= size
        )
    ),
    f AS (SELECT lang, size, phrase, count(*) AS f FROM g GROUP BY ALL),
    t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
    c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 100),
    inside AS (
        SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(a) AS longer
        FROM (
            SELECT lang, w, k, a, unnest(range(1, size - k + 2)) AS i
            FROM c, (SELECT unnest(range(2, 5)) AS k) WHERE k < size
        )
        GROUP BY ALL
    ),
    open AS (SELECT c.* FROM c LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
    cuts AS (
        SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, size)) AS k FROM open)
    ),
    scored AS (
        SELECT cuts.lang, cuts.phrase, a, k, fl.f AS l, fr.f AS r, n,
               CAST((1000::HUGEINT * a * n) // (fl.f::HUGEINT * fr.f) AS BIGINT) AS score
        FROM cuts
        JOIN f fl ON fl.lang = cuts.lang AND fl.phrase = first
        JOIN f fr ON fr.lang = cuts.lang AND fr.phrase = rest
        JOIN t ON t.lang = cuts.lang
    ),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
               phrase, a, l, r, n, score
        FROM best
    )
    SELECT * FROM ranked WHERE rank <= 2000
"""

ORACLES = {
    "op1_quality_rules": OP1,
    "op2_chat_formatting": _op2(),
    "op7_warc": OP7,
    "op8_decontamination": OP8,
    "op12_filter_audit": OP12,
    "op13_phrases": OP13,
}
