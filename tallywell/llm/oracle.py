"""The SQL that queries of this package are compared with, where SQL can express them."""

from __future__ import annotations

# fixed values: as in the operators
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOOKALIKE = r"([<\[])(\\*)(</?SYS>>|/?(?:INST|ROLE|TURN)\]|/?s>)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]"


def _levels(name: str, leaves: str, group: str) -> str:
    """All nodes of the trees over ``leaves`` (group, pos, n, h), level by level."""
    return f"""{name} AS (
        SELECT {group}, 0 AS level, pos, n, h FROM {leaves}
        UNION ALL
        SELECT {group}, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
        FROM {name} WHERE n > 1 GROUP BY {group}, level, n, pos // 2)"""


def _folds(name: str, starts: str, levels: str, group: str) -> str:
    """From ``starts`` (doc_id, group, pos, h) up the trees of ``levels``: the digest and all siblings so far."""
    return f"""{name} AS (
        SELECT doc_id, {group}, 0 AS level, pos, h, '' AS siblings FROM {starts}
        UNION ALL
        SELECT f.doc_id, f.{group}, f.level + 1, f.pos // 2,
            sha256(CASE WHEN f.pos % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE s.h || f.h END),
            f.siblings || coalesce(s.h, '')
        FROM {name} f
        JOIN {levels} own ON own.{group} IS NOT DISTINCT FROM f.{group} AND own.level = f.level AND own.pos = f.pos AND own.n > 1
        LEFT JOIN {levels} s ON s.{group} IS NOT DISTINCT FROM f.{group} AND s.level = f.level AND s.pos = xor(f.pos, 1))"""


def _leaf(n_chars: str) -> str:
    values = ("doc_id", "source", "lang", n_chars, "text")
    framed = (f"coalesce(strlen(({v})::VARCHAR)::VARCHAR || ':' || ({v})::VARCHAR, '-')" for v in values)
    return f"sha256({' || '.join(framed)})"


_MANIFEST = f"""
WITH RECURSIVE
crc_table AS (
    SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, step: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)),
marked AS (
    SELECT d.*, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 7 = 0 AS tampered
    FROM documents d, crc_table),
leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS h, CASE WHEN tampered THEN {_leaf("n_chars + 1")} ELSE {_leaf("n_chars")} END AS claimed,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
    FROM marked),
{_levels("nodes", "leaves", "lang")},
subroots AS (
    SELECT lang, h, 0 AS one, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
{_levels("tops", "subroots", "one")},
starts AS (SELECT doc_id, lang, pos, claimed AS h FROM leaves),
{_folds("climbs", "starts", "nodes", "lang")},
at_subroot AS (
    SELECT c.doc_id, 0 AS one, s.pos, c.h, c.siblings AS below, s.h AS subroot
    FROM climbs c JOIN nodes top ON top.lang IS NOT DISTINCT FROM c.lang AND top.level = c.level AND top.pos = c.pos AND top.n = 1
    JOIN subroots s ON s.lang IS NOT DISTINCT FROM c.lang),
{_folds("climbs_on", "at_subroot", "tops", "one")},
ends AS (
    SELECT c.doc_id, c.h, c.siblings, top.h AS root FROM climbs_on c JOIN tops top ON top.level = c.level AND top.pos = c.pos AND top.n = 1)
SELECT l.doc_id, l.h AS leaf, a.subroot, e.root, sha256(a.below || e.siblings) AS proof_sha256, e.h AS folded_root, e.h = e.root AS verified
FROM leaves l JOIN at_subroot a USING (doc_id) JOIN ends e USING (doc_id)
"""

_CHATS = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(i)),
escaped AS (
    SELECT *, length(regexp_replace(text, '{_LOOKALIKE}', '\\1\\\\\\2\\3', 'g')) AS chars,
        CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
            ELSE 26 + length(regexp_replace(role, '{_LOOKALIKE}', '\\1\\\\\\2\\3', 'g')) END AS marks
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(chars + marks)::BIGINT AS formatted_chars, true AS identical
FROM escaped GROUP BY conv_id
"""

_SEARCH = f"""
WITH terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM documents),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERM}')) AS term FROM benchmark),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM lengths),
found AS (SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM found, corpus GROUP BY term, docs),
scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // length))))::BIGINT AS score
    FROM asked JOIN found USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), corpus
    GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""

# copies of a page on its source are one page; a line is boilerplate on over 2 % of the pages, five at least
_LINE_DEDUP = f"""
WITH pages AS (SELECT DISTINCT source, text FROM documents),
sizes AS (SELECT source, count(*) AS total FROM pages GROUP BY source),
lines AS (SELECT DISTINCT source, text, unnest(string_split(text, chr(10))) AS line FROM pages),
bad AS (
    SELECT l.source, l.line FROM lines l JOIN sizes s ON s.source IS NOT DISTINCT FROM l.source
    WHERE regexp_matches(l.line, '{_WORD}')
    GROUP BY l.source, l.line, s.total HAVING count(*) >= 5 AND count(*) > 0.02::DOUBLE * s.total),
places AS (
    SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
    FROM documents WHERE text IS NOT NULL),
cut AS (
    SELECT p.doc_id, coalesce(string_agg(p.line, chr(10) ORDER BY p.i) FILTER (b.line IS NULL), '') AS text, count(b.line) AS dropped
    FROM places p LEFT JOIN bad b ON b.source IS NOT DISTINCT FROM p.source AND b.line = p.line GROUP BY p.doc_id)
SELECT d.doc_id, c.text, d.lang, d.source, d.n_chars, coalesce(c.dropped, 0)::INTEGER AS lines_dropped
FROM documents d LEFT JOIN cut c USING (doc_id)
"""

def _count(characters: str) -> str:
    return f"length(regexp_replace(line, '[^{characters}]', '', 'g'))"


def _ink(text: str) -> str:
    return f"length(regexp_replace({text}, '[\\x09-\\x0D\\x20]', '', 'g'))"


def _phrases(pattern: str, share: int) -> str:
    rest = _ink(f"regexp_replace(lower(line), '{pattern}', '', 'g')")
    return f"(regexp_matches(lower(line), '{pattern}') AND (ink - {rest}) * 100 >= ink * {share})"


# fixed values: as in the operator
_SENTENCE_END = r"""[.!?…。！？؟।:;]["''”’»)\]]*([\x09-\x0D\x20]|\z)"""
_NOTICES = (
    r"\bcopyright (?:©|\(c\))|\b(?:all rights reserved|copyright [0-9]{4}|terms (?:of|and) (?:use|service|conditions)"
    r"|privacy policy|cookie (?:policy|settings|notice)|(?:use|accept|uses) (?:of )?cookies|enable javascript"
    r"|lorem ipsum|skip to (?:main )?content|(?:licensed|released) under(?: [a-z0-9.-]+){0,5} licen[cs]e)\b"
)
_PROMPTS = (
    r"\b(?:click here|read more|sign (?:up|in)|log ?in|subscribe|share (?:this|on)|follow us|powered by)\b"
)

_QUALITY = f"""
WITH words AS (
    SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i
    FROM (SELECT doc_id, regexp_extract_all(text, '{_WORD}+') AS w FROM documents)),
windows AS (
    SELECT doc_id, i, w, lead(w) OVER d AS w2, lead(w, 2) OVER d AS w3 FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
repeats AS (
    SELECT doc_id, i, w, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w, w2, w3) > 1 AS again FROM windows),
covered AS (
    SELECT doc_id, w, again OR coalesce(lag(again) OVER d, false) OR coalesce(lag(again, 2) OVER d, false) AS repeated
    FROM repeats WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
by_word AS (
    SELECT doc_id, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, count(*) FILTER (repeated) AS n_repeat_words
    FROM covered GROUP BY doc_id),
lines AS (
    SELECT doc_id, line, {_ink("line")} AS ink FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents)),
judged AS (
    SELECT doc_id, line, ink, ink > 0 AND (
        NOT regexp_matches(line, '{_SENTENCE_END}')
        OR ({_count("|»«›‹•·")} >= 3 AND {_count("|»«›‹•·")} * 100 >= ink * 5)
        OR ({_count("#*$%&|<>")} >= 3 AND {_count("#*$%&|<>")} * 100 >= ink * 10)
        OR ({_count("!")} >= 3 AND {_count("!")} * 100 >= ink * 8)
        OR (ink >= 20 AND upper(line) = line AND lower(line) <> line)
        OR (length(line) <= 200 AND ({_phrases(_NOTICES, 20)} OR {_phrases(_PROMPTS, 50)}))) AS bad
    FROM lines),
by_line AS (
    SELECT doc_id, count(*) FILTER (ink > 0) - count(DISTINCT line) FILTER (ink > 0) AS n_dup_lines,
        count(*) FILTER (bad) AS lines_removed, coalesce(sum(ink) FILTER (bad), 0) AS lost
    FROM judged GROUP BY doc_id),
measured AS (
    SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words, lines_removed, lost
    FROM documents d JOIN by_line USING (doc_id) LEFT JOIN by_word USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines_removed,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost * 100 <= word_chars * 50 AS kept
FROM measured
"""

SQL: dict[str, str] = {
    "op5_quality": _QUALITY,
    "op7_line_dedup": _LINE_DEDUP,
    "op11_manifest": _MANIFEST,
    "op12_chats": _CHATS,
    "op13_search": _SEARCH,
}
