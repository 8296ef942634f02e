"""The queries that SQL can state, for comparison by an independent engine (DuckDB)."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"

# kind, expression, group, least length: stated apart from the operator's own rules.
_KINDS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("google", "AIza[A-Za-z0-9_-]{35}", 0, 1),
    ("stripe", "[sr]k_live_[A-Za-z0-9]{16,}", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("pem", "-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----", 0, 1),
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secrets() -> str:
    """A match starts after the pieces and matches before it."""
    parts = []
    for order, (kind, pattern, group, least) in enumerate(_KINDS):
        p = _quoted(pattern)
        parts.append(
            f"SELECT r, {order} AS k, '{kind}' AS kind, s, s + length(m[i]) AS e FROM ("
            f"SELECT r, m, g, i, list_sum(list_transform(p[1:i], lambda x: length(x))) + "
            f"coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s FROM ("
            f"SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ("
            f"SELECT r, string_split_regex(body, {p}) AS p, regexp_extract_all(body, {p}) AS m, "
            f"regexp_extract_all(body, {p}, {group}) AS g FROM docs))) WHERE length(g[i]) >= {least}"
        )
    spans = " UNION ALL ".join(parts)
    text = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT)"
    return (
        "WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents), "
        f"spans AS ({spans}), found AS (SELECT r, "
        + ", ".join(f"COUNT(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in ("assign", "access", "hex"))
        + f", string_agg({text}, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base, "
        f"string_agg({text}, ',' ORDER BY s, k) AS spans FROM spans GROUP BY r) "
        "SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, "
        "coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans "
        "FROM docs LEFT JOIN found USING (r)"
    )


def quality() -> str:
    from .quality import STOP_FORMS  # a word list, no logic

    stop = ", ".join(_quoted(w) for w in STOP_FORMS)
    rules = {
        "min_words": "n_words < 20",
        "repeated_windows": "100 * n_repeat_words > 30 * n_words",
        "word_length": "word_chars < 1.5 * n_words OR word_chars > 15 * n_words",
        "symbol_ratio": "n_words > 0 AND n_symbols / n_words > 0.3",
        "duplicate_lines": "n_lines > 0 AND n_dup_lines / n_lines > 0.5",
        "bullet_lines": "n_lines > 0 AND n_bullet_lines / n_lines > 0.9",
        "stop_words": "n_words > 0 AND n_stop_words / n_words < 0.005",
        "stutter": "n_words > 0 AND n_stutter_words / n_words > 0.3",
        "upper_case": "word_chars > 0 AND n_upper / word_chars > 0.5",
        "shouting": "n_words > 0 AND n_exclaim / n_words > 0.3",
    }
    failed = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in rules.items())
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
    cut AS (SELECT r, doc_id, body,
        list_filter(string_split_regex(body, '{SPACE}+'), lambda x: x <> '') AS w,
        list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM docs),
    windows AS (SELECT r, i, w[i:i + 7] AS x FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM cut WHERE len(w) > 8)),
    twice AS (SELECT r, i FROM (SELECT r, i, COUNT(*) OVER (PARTITION BY r, x) AS n FROM windows) WHERE n > 1),
    covered AS (SELECT r, COUNT(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY r),
    counted AS (SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
        length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
        len(list_filter(l, lambda x: regexp_matches(ltrim(x), '^[-*•]'))) AS n_bullet_lines,
        len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutter_words,
        length(regexp_replace(body, '\\P{{Lu}}', '', 'g')) AS n_upper,
        length(body) - length(replace(body, '!', '')) AS n_exclaim,
        coalesce(n, 0) AS n_repeat_words FROM cut LEFT JOIN covered USING (r)),
    judged AS (SELECT *, concat_ws(',', {failed}) AS failed_rules FROM counted)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, failed_rules = '' AS kept, failed_rules
    FROM judged"""


def chat() -> str:
    escaped = r"regexp_replace(text, '(\\*)(</?s>|\[/?INST\])', '\\\1\2', 'g')"
    return f"""
    WITH talk AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
        COUNT(*) OVER (PARTITION BY conv_id) AS n, 9 + length(role) + length({escaped}) AS chars FROM talk),
    summed AS (SELECT *, SUM(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM placed),
    gathered AS (SELECT conv_id, COUNT(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY k) AS turns,
        coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '') AS loss,
        CAST(SUM(upto) FILTER (WHERE role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars,
        COUNT(*) FILTER (WHERE role = 'assistant' OR k = n) AS n_examples FROM summed GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars,
      sha256(loss) AS loss_sha256, formatted_chars, n_examples FROM gathered"""


def near_duplicates() -> str:
    """All pairs with a common shingle, then everything links reach."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    WITH RECURSIVE cut AS (SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{SPACE}+'), lambda x: x <> '') AS w FROM documents),
    runs AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM (
        SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM cut WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, COUNT(*) AS n FROM runs GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS c FROM runs a JOIN runs b USING (x)
        WHERE a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN sizes s ON a = s.doc_id JOIN sizes t ON b = t.doc_id
        WHERE 100 * c >= 85 * (s.n + t.n - c)),
    reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    low AS (SELECT a, MIN(b) AS b FROM reach GROUP BY a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
      doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
    FROM cut LEFT JOIN sizes USING (doc_id) LEFT JOIN low ON doc_id = a"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scan": secrets(),
        "op3_quality_rules": quality(),
        "op5_chat_format": chat(),
        "op8_minhash_dedup": near_duplicates(),
    }
