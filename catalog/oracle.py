"""Plain SQL for every registered query, for DuckDB over the same tables.

Pairs are a range join of word positions here, stripes are aggregated strings
and documents are counted with `count(DISTINCT ...)`: none of it follows the
plans of the Spark jobs. Stems use the published rule tables on both sides.
"""

from __future__ import annotations

from catalog.inputs import STOPWORDS, TOP_WORDS, TOP_WORDS_AND_NUMERAL
from lexigrid.functions import porter

COUNTS = "length(word) > 2 AND NOT regexp_full_match(word, '[ivx]+')"
TRIM = "regexp_replace({}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def lower(text: str) -> str:
    # Capital dotted I lowers to two characters, the second no letter a-z.
    return f"lower(replace({text}, chr(304), 'i' || chr(775)))"


def with_(*tables: str) -> str:
    return "WITH " + ",\n".join(tables) + "\n"


def values(name: str, listed: list[str]) -> str:
    return f"{name}(word) AS (VALUES " + ", ".join(f"('{word}')" for word in listed) + ")"


STOP = values("stop", STOPWORDS)
TOP = values("top", TOP_WORDS)


def lines(table: str = "documents", key: str = "doc_id", text: str = "text") -> str:
    return f"""lines AS (
  SELECT doc_id, line_no, line FROM (
    SELECT doc_id, unnest(parts) AS line, CAST(generate_subscripts(parts, 1) - 1 AS INTEGER) AS line_no,
           len(parts) AS n_parts
    FROM (SELECT {key} AS doc_id, regexp_split_to_array({text}, '\\r\\n|\\n|\\r') AS parts FROM {table}))
  WHERE NOT (line = '' AND line_no = n_parts - 1))"""


def tokens(split: str | None = None, word: str = "word") -> str:
    split = split or f"regexp_split_to_array({lower('line')}, '[^a-z]+')"
    return f"""tokens AS (
  SELECT doc_id, line_no, pos, {word} AS word FROM (
    SELECT doc_id, line_no, unnest(ws) AS word, CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS pos
    FROM (SELECT doc_id, line_no, {split} AS ws FROM lines))
  WHERE word <> '')"""


TOKENS = (lines(), tokens())
COUNTED = f"counted AS (SELECT * FROM tokens WHERE {COUNTS})"
UNSTOPPED = f"counted AS (SELECT * FROM tokens WHERE {COUNTS} AND word NOT IN (SELECT word FROM stop))"
WORDCOUNT = "wordcount AS (SELECT word, count(*) AS n FROM counted GROUP BY word)"
WORDCOUNT_TABLES = (*TOKENS, STOP, UNSTOPPED, WORDCOUNT)


def pairs(distance: int) -> tuple[str, ...]:
    return (
        f"listed AS (SELECT doc_id, line_no, pos, word FROM tokens WHERE {COUNTS} AND word IN (SELECT word FROM top))",
        f"""pairs AS (
  SELECT a.doc_id, a.line_no, a.pos, a.word AS w1, b.word AS w2
  FROM listed a JOIN listed b ON a.doc_id = b.doc_id AND a.line_no = b.line_no
   AND b.pos > a.pos AND b.pos <= a.pos + {distance})""",
    )


PAIR_COUNTS = "pair_counts AS (SELECT w1, w2, count(*) AS n FROM pairs GROUP BY w1, w2)"


def stripe_of(keys: str, centres: str = "listed") -> str:
    """Rendered stripes of each `keys` group, empty ones for centres without pairs."""
    on = " AND ".join(f"c.{k} = p.{k}" for k in (*keys.split(", "), "w1") if k)
    prefix = f"{keys}, " if keys else ""
    return f"""stripes AS (
  SELECT {', '.join('c.' + k for k in (*keys.split(', '), 'w1') if k)},
         '{{' || coalesce(string_agg(p.w2 || '=' || p.n, ', ' ORDER BY p.w2), '') || '}}' AS stripe
  FROM (SELECT DISTINCT {prefix}word AS w1 FROM {centres}) c
  LEFT JOIN (SELECT {prefix}w1, w2, count(*) AS n FROM pairs GROUP BY {prefix}w1, w2) p ON {on}
  GROUP BY {', '.join('c.' + k for k in (*keys.split(', '), 'w1') if k)})"""


# -- stems ------------------------------------------------------------------


def _rules(table: str, test: str) -> str:
    branches = []
    for suffix, ending in sorted(porter.parse_rules(table), key=lambda rule: -len(rule[0])):
        base = f"left(w, length(w) - {len(suffix)})"
        measured = f"{base} || '{ending}'" if test == "over_1" else base
        branches.append(
            f"WHEN w LIKE '%{suffix}' THEN CASE WHEN {_MEASURE[test].format(measured)} "
            f"THEN {base} || '{ending}' ELSE w END"
        )
    return "CASE " + " ".join(branches) + " ELSE w END"


_V, _C = porter.VOWEL, porter.CONSONANT
_MEASURE = {
    "over_0": f"regexp_matches({{}}, '{_V}{_C}')",
    "over_1": f"regexp_matches({{}}, '{_V}{_C}+{_V}+{_C}')",
    "vowel": f"regexp_matches({{}}, '{_V}')",
    "short": f"regexp_matches({{}}, '{porter.SHORT_SYLLABLE}')",
}


def _m(test: str, text: str) -> str:
    return _MEASURE[test].format(text)


_CUT = "left(w, length(w) - {})".format
_STEPS = [
    "CASE WHEN length(w) < 3 THEN w || '.' ELSE "
    "regexp_replace(regexp_replace(w, '(^|[aeiou])y', '\\1Y', 'g'), 'yy', 'yY', 'g') END",
    f"CASE WHEN w LIKE '%sses' OR w LIKE '%ies' THEN {_CUT(2)} WHEN w LIKE '%ss' THEN w "
    f"WHEN w LIKE '%s' THEN {_CUT(1)} ELSE w END",
    f"CASE WHEN w LIKE '%eed' THEN CASE WHEN {_m('over_0', _CUT(3))} THEN {_CUT(1)} ELSE w END "
    f"WHEN w LIKE '%ed' AND {_m('vowel', _CUT(2))} THEN {_CUT(2)} || '+' "
    f"WHEN w LIKE '%ing' AND {_m('vowel', _CUT(3))} THEN {_CUT(3)} || '+' ELSE w END",
    f"CASE WHEN w NOT LIKE '%+' THEN w "
    f"WHEN w LIKE '%at+' OR w LIKE '%bl+' OR w LIKE '%iz+' THEN {_CUT(1)} || 'e' "
    f"WHEN regexp_matches({_CUT(1)}, '{porter.DOUBLED}') THEN {_CUT(2)} "
    f"WHEN {_m('over_0', _CUT(1))} AND NOT {_m('over_1', _CUT(1))} AND {_m('short', _CUT(1))} "
    f"THEN {_CUT(1)} || 'e' ELSE {_CUT(1)} END",
    f"CASE WHEN lower(w) LIKE '%y' AND {_m('vowel', _CUT(1))} THEN {_CUT(1)} || 'i' ELSE w END",
    _rules(porter.STEP_2, "over_0"),
    _rules(porter.STEP_3, "over_0"),
    _rules(porter.STEP_4, "over_1"),
    f"CASE WHEN w LIKE '%e' AND ({_m('over_1', 'w')} OR ({_m('over_0', 'w')} AND NOT {_m('short', _CUT(1))})) "
    f"THEN {_CUT(1)} ELSE w END",
    f"CASE WHEN w LIKE '%ll' AND {_m('over_1', 'w')} THEN {_CUT(1)} ELSE w END",
    "lower(rtrim(w, '.'))",
]


def stems(source: str = "tokens", name: str = "stems") -> tuple[str, ...]:
    """`stems(word, stem)` for the distinct words of length 2 or more of a table."""
    steps = [f"{name}_0 AS MATERIALIZED (SELECT DISTINCT word, word AS w FROM {source} WHERE length(word) >= 2)"]
    for i, expression in enumerate(_STEPS):
        steps.append(f"{name}_{i + 1} AS MATERIALIZED (SELECT word, {expression} AS w FROM {name}_{i})")
    steps.append(f"{name} AS (SELECT word, w AS stem FROM {name}_{len(_STEPS)})")
    return tuple(steps)


STEMS = stems()
STEMMED = (
    *TOKENS,
    STOP,
    UNSTOPPED,
    *STEMS,
    f"terms AS (SELECT doc_id, word AS term FROM (SELECT c.doc_id, s.stem AS word FROM counted c JOIN stems s USING (word)) "
    f"WHERE {COUNTS} AND word NOT IN (SELECT word FROM stop))",
)
UNSTEMMED = (*TOKENS, STOP, UNSTOPPED, "terms AS (SELECT doc_id, word AS term FROM counted)")
DF = "df AS (SELECT term, count(DISTINCT doc_id) AS df FROM terms GROUP BY term)"
DICTIONARY = "dictionary AS (SELECT term, df FROM df ORDER BY df DESC, term LIMIT 100)"
SCORED_STEMS = "scored AS (SELECT doc_id, line_no, stem AS term FROM tokens JOIN stems USING (word) WHERE length(word) >= 2)"
SCORED_WORDS = "scored AS (SELECT doc_id, line_no, word AS term FROM tokens WHERE length(word) >= 2)"
TF = "tf AS (SELECT doc_id, term, count(*) AS tf, any_value(df) AS df FROM scored JOIN dictionary USING (term) GROUP BY doc_id, term)"
STEM_TF = (*STEMMED, DF, DICTIONARY, SCORED_STEMS, TF)
SCORE = "tf * ln(10000.0 / df + 1)"
SCORES = f"SELECT doc_id, term, round({SCORE}, 6) AS score FROM tf"


def _renamed(table: str, *names: str) -> str:
    """A table expression with some of its table names given a prefix."""
    for name in names:
        table = table.replace(name, f"conv_{name}")
    return table


def conversation_df() -> tuple[str, ...]:
    """Stemmed document frequency of the conversations, all under `conv_` names."""
    own = (
        lines("conversations", "conv_id"),
        tokens(),
        UNSTOPPED,
    )
    tables = [_renamed(t, "lines", "tokens", "counted") for t in own]
    return (
        STOP,
        *tables,
        *stems("conv_tokens", "conv_stems"),
        f"terms AS (SELECT doc_id, word AS term FROM (SELECT c.doc_id, s.stem AS word FROM conv_counted c JOIN conv_stems s USING (word)) "
        f"WHERE {COUNTS} AND word NOT IN (SELECT word FROM stop))",
        DF,
        DICTIONARY,
    )


def top50(tie: str) -> str:
    return f"SELECT word, n FROM wordcount ORDER BY n DESC, word {tie} LIMIT 50"


def build() -> dict[str, str]:
    sql: dict[str, str] = {}

    # sources
    sql["scan_lines"] = with_(lines()) + "SELECT doc_id, line_no, line FROM lines"
    sql["doc_id_from_path"] = """
SELECT doc_id, path, regexp_replace(regexp_extract(path, '[^/]*$'), '\\.[^.]+$', '') AS file_id
FROM (SELECT doc_id, '/corpus/' || source || '/' || doc_id ||
             CASE lang WHEN 'en' THEN '.txt' WHEN 'de' THEN '.tar.gz' ELSE '' END AS path FROM documents)"""
    sql["stopwords_parse"] = (
        with_(lines())
        + f"SELECT DISTINCT word FROM (SELECT {TRIM.format(lower('line'))} AS word FROM lines) WHERE word <> ''"
    )
    sql["topwords_parse"] = (
        with_(*TOKENS, COUNTED, WORDCOUNT)
        + "SELECT DISTINCT word FROM wordcount WHERE n <> 2"
    )
    sql["df_dictionary_parse"] = (
        with_(
            *TOKENS,
            COUNTED,
            "by_lang AS (SELECT word AS term, lang, count(DISTINCT doc_id) AS df FROM counted JOIN documents USING (doc_id) GROUP BY word, lang)",
        )
        + "SELECT term, max_by(df, lang) AS df FROM by_lang WHERE lang IN ('de', 'en') GROUP BY term"
    )

    # words
    place = "SELECT doc_id, line_no, pos, word FROM "
    sql["tokens"] = with_(*TOKENS) + place + "tokens"
    sql["valid_tokens"] = with_(*TOKENS, COUNTED) + place + "counted"
    sql["roman_tokens_dropped"] = with_(*TOKENS) + place + "tokens WHERE length(word) > 2 AND regexp_full_match(word, '[ivx]+')"
    sql["stopwords_removed"] = with_(*TOKENS, STOP, UNSTOPPED) + place + "counted"
    sql["topword_tokens"] = with_(*TOKENS, TOP) + place + "tokens WHERE word IN (SELECT word FROM top)"
    sql["stem_dictionary"] = with_(*TOKENS, *STEMS) + "SELECT word, stem FROM stems"

    # word counts
    count = "SELECT word, n FROM wordcount"
    sql["wordcount"] = with_(*WORDCOUNT_TABLES) + count
    sql["wordcount_no_stopwords"] = with_(*TOKENS, COUNTED, WORDCOUNT) + count
    sql["wordcount_case_lower_after"] = (
        with_(
            lines(),
            tokens("regexp_split_to_array(line, '[^A-Za-z]+')", "lower(word)"),
            STOP,
            UNSTOPPED,
            WORDCOUNT,
        )
        + count
    )
    sql["wordcount_case_strict"] = (
        with_(lines(), tokens("regexp_split_to_array(line, '[^a-z]+')"), STOP, UNSTOPPED, WORDCOUNT) + count
    )
    sql["wordcount_top50"] = with_(*WORDCOUNT_TABLES) + top50("ASC")
    sql["wordcount_top50_shell_ties"] = with_(*WORDCOUNT_TABLES) + top50("DESC")
    sql["wordcount_top50_ranked"] = (
        with_(*WORDCOUNT_TABLES)
        + "SELECT CAST(row_number() OVER (ORDER BY n DESC, word) AS INTEGER) AS place, word, n "
        "FROM wordcount QUALIFY place <= 50"
    )
    sql["wordcount_pages_top50"] = (
        with_(lines("pages", "page_id", "html"), tokens(), STOP, UNSTOPPED, WORDCOUNT) + top50("ASC")
    )
    sql["wordcount_tsv_lines"] = with_(*WORDCOUNT_TABLES) + "SELECT word || chr(9) || n AS line FROM wordcount"

    # pairs
    for d in (1, 2, 3, 4):
        sql[f"pairs_d{d}"] = with_(*TOKENS, TOP, *pairs(d), PAIR_COUNTS) + "SELECT w1, w2, n FROM pair_counts"
        sql[f"stripes_d{d}"] = with_(*TOKENS, TOP, *pairs(d), stripe_of("")) + "SELECT w1, stripe FROM stripes"
    sql["pairs_lead_window_d2"] = sql["pairs_d2"]
    for d in (1, 2, 3, 4):
        sql[f"pairs_line_rollup_d{d}"] = sql[f"pairs_d{d}"]
        sql[f"stripes_line_rollup_d{d}"] = sql[f"stripes_d{d}"]
    sql["pairs_by_line_d2"] = (
        with_(*TOKENS, TOP, *pairs(2))
        + "SELECT doc_id, line_no, w1, w2, count(*) AS n FROM pairs GROUP BY doc_id, line_no, w1, w2"
    )
    sql["pairs_rendered_d1"] = (
        with_(*TOKENS, TOP, *pairs(1), PAIR_COUNTS) + "SELECT w1 || ',' || w2 || chr(9) || n AS line FROM pair_counts"
    )
    sql["cooccurrence_from_corpus_d2"] = (
        with_(*WORDCOUNT_TABLES, f"top AS ({top50('ASC')})", *pairs(2), PAIR_COUNTS)
        + "SELECT w1, w2, n FROM pair_counts"
    )

    # stripes
    sql["stripes_rendered_d2"] = (
        with_(*TOKENS, TOP, *pairs(2), stripe_of("")) + "SELECT w1 || chr(9) || stripe AS line FROM stripes"
    )
    sql["stripes_by_line_d2"] = (
        with_(*TOKENS, TOP, *pairs(2), stripe_of("doc_id, line_no")) + "SELECT doc_id, line_no, w1, stripe FROM stripes"
    )
    sql["occurrence_stripes_d3"] = (
        with_(*TOKENS, TOP, *pairs(3), stripe_of("doc_id, line_no, pos"))
        + "SELECT doc_id, line_no, pos, w1, stripe FROM stripes"
    )
    loose = (
        f"listed AS (SELECT doc_id, line_no, pos, word FROM tokens WHERE {COUNTS} AND word IN (SELECT word FROM top))",
        """pairs AS (
  SELECT a.word AS w1, b.word AS w2 FROM listed a JOIN tokens b
    ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND b.pos > a.pos AND b.pos <= a.pos + 2
  WHERE b.word IN (SELECT word FROM top))""",
    )
    sql["stripes_loose_neighbour_d2"] = (
        with_(*TOKENS, values("top", TOP_WORDS_AND_NUMERAL), *loose, stripe_of(""))
        + "SELECT w1, stripe FROM stripes"
    )

    # documents
    sql["line_distinct_terms"] = (
        with_(*TOKENS, STOP, UNSTOPPED)
        + """SELECT l.doc_id, l.line_no, coalesce(string_agg(DISTINCT c.word, ' ' ORDER BY c.word), '') AS terms
FROM lines l LEFT JOIN counted c USING (doc_id, line_no) GROUP BY l.doc_id, l.line_no"""
    )
    df = "SELECT term, df FROM df"
    sql["document_frequency"] = sql["document_frequency_of_lines"] = with_(*STEMMED, DF) + df
    sql["document_frequency_unstemmed"] = with_(*UNSTEMMED, DF) + df
    sql["document_frequency_conversations"] = with_(*conversation_df()[:-1]) + df
    sql["df_top100"] = with_(*STEMMED, DF, DICTIONARY) + "SELECT term, df FROM dictionary"
    sql["df_top100_unstemmed"] = with_(*UNSTEMMED, DF, DICTIONARY) + "SELECT term, df FROM dictionary"
    sql["df_tsv_lines"] = with_(*STEMMED, DF) + "SELECT term || chr(9) || df AS line FROM df"

    sql["term_frequency"] = with_(*STEM_TF) + "SELECT doc_id, term, tf FROM tf"
    sql["doc_stripe_encoded"] = (
        with_(*STEM_TF)
        + "SELECT doc_id, string_agg(term || ':' || tf, '|' ORDER BY term) AS stripe FROM tf GROUP BY doc_id"
    )
    sql["doc_stripe_merged"] = with_(*STEM_TF) + "SELECT doc_id, term, tf FROM tf"
    given = with_(*conversation_df()) + "SELECT term, df FROM dictionary"
    sql["tfidf_from_stripes"] = with_(
        f"encoded AS ({sql['doc_stripe_encoded']})",
        f"given AS ({given})",
        "parts AS (SELECT doc_id, unnest(string_split(stripe, '|')) AS part FROM encoded)",
        "decoded AS (SELECT doc_id, split_part(part, ':', 1) AS term, sum(split_part(part, ':', 2)::BIGINT)::BIGINT AS tf "
        "FROM parts GROUP BY ALL)",
        "tf AS (SELECT doc_id, term, tf, coalesce(df, 1) AS df FROM decoded LEFT JOIN given USING (term))",
    ) + f"SELECT doc_id, term, df, round({SCORE}, 6) AS score FROM tf"
    sql["tfidf_from_corpus"] = with_(*STEM_TF) + SCORES
    sql["tfidf_tsv_lines"] = (
        with_(*STEM_TF) + f"SELECT printf('%s%s%s%s%.6f', doc_id::VARCHAR, chr(9), term, chr(9), {SCORE}) AS line FROM tf"
    )
    sql["tfidf_scores_unstemmed"] = with_(*UNSTEMMED, DF, DICTIONARY, SCORED_WORDS, TF) + SCORES
    sql["tfidf_scores"] = with_(*conversation_df(), *TOKENS, *STEMS, SCORED_STEMS, TF) + SCORES
    return sql
