"""Named queries of what is learned or derived from the tables' own words, and the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as tx
from lectern.operators import filters, pronounce, sentence_ends, transforms
from lectern.operators.affixes import Rule, accepted
from lectern.plans import catalog as base
from lectern.saving import saved

UTT = base.UTT

# pronunciations: a made lexicon in which a letter's phone depends on the letter before it, so that histories matter

#: Every letter stands for one phone: the units are known, and what is compared is the model and its decoding.
PAIRS = ((1, 1),)


def made_lexicon(spark, sf_dir: str) -> DataFrame:
    """The benchmark's words of plain letters. A phone is the letter, with 1 behind a vowel, 2 behind one of l-s, and 0."""
    words = base.lexicon(spark, sf_dir).where("word RLIKE '^[a-z]+$'")
    letters = F.filter(F.split("word", ""), lambda x: x != "")
    before = lambda i: F.when(i == 0, F.lit("")).otherwise(F.element_at(letters, i))
    kind = lambda x: F.when(x.rlike("[aeiou]"), "1").when(x.rlike("[l-s]"), "2").otherwise("0")
    return words.select("word", F.transform(letters, lambda x, i: F.concat(F.upper(x), kind(before(i)))).alias("phones"))


def model(spark, sf_dir: str) -> pronounce.Pronouncer:
    return pronounce.learn(made_lexicon(spark, sf_dir), 3, PAIRS, rounds=2)


def q_learned_words(spark, sf_dir):
    words = base.utterances(spark, sf_dir).select(F.explode(F.regexp_extract_all(F.lower("reading"), F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct().sortWithinPartitions("word")
    return words.select("word", F.array_join(model(spark, sf_dir).phones(F.col("word")), "|").alias("phones"))


def q_learned_arpa(spark, sf_dir):
    rows = base.utterances(spark, sf_dir)
    said = transforms.eng_to_arpa(rows, "reading", made_lexicon(spark, sf_dir), "phones", spelled=model(spark, sf_dir).phones)
    return said.select("utt_id", F.array_join("phones", "|").alias("phones"))


def _pronounce_sql(words: str) -> str:
    """decoded: word and phones by the model, for a query that gives words. Each round takes every word one letter further; letters that no unit has are skipped."""
    lowest = "g1.n / (SELECT sum(n) FROM g1)::DOUBLE"
    mid = f"CASE WHEN s1.total IS NULL THEN {lowest} ELSE (coalesce(g2.n, 0) + s1.kinds * {lowest}) / (s1.total + s1.kinds) END"
    share = f"CASE WHEN s2.total IS NULL THEN {mid} ELSE (coalesce(g3.n, 0) + s2.kinds * ({mid})) / (s2.total + s2.kinds) END"
    return f"""{base.LEX}, taught AS (
  SELECT word, list_transform(range(1, length(word) + 1), lambda i: upper(word[i]) || CASE WHEN i > 1 AND word[i - 1] IN ('a', 'e', 'i', 'o', 'u') THEN '1' WHEN i > 1 AND word[i - 1] BETWEEN 'l' AND 's' THEN '2' ELSE '0' END) AS phones
  FROM lex WHERE regexp_full_match(word, '[a-z]+')
), line AS (
  SELECT list_concat(['<', '<'], phones, ['>']) AS l FROM taught WHERE length(word) <= {pronounce.LONGEST}
), grams AS (
  SELECT unnest(list_transform(range(3, len(l) + 1), lambda i: {{'a': l[i - 2], 'b': l[i - 1], 'u': l[i]}})) AS g FROM line
), g3 AS MATERIALIZED (SELECT g.a AS a, g.b AS b, g.u AS u, count(*) AS n FROM grams GROUP BY ALL
), g2 AS MATERIALIZED (SELECT g.b AS b, g.u AS u, count(*) AS n FROM grams GROUP BY ALL
), g1 AS MATERIALIZED (SELECT g.u AS u, count(*) AS n FROM grams GROUP BY ALL
), s2 AS (SELECT a, b, sum(n) AS total, count(*) AS kinds FROM g3 GROUP BY ALL
), s1 AS (SELECT b, sum(n) AS total, count(*) AS kinds FROM g2 GROUP BY ALL
), marks AS (SELECT u AS m FROM g1 WHERE u <> '>' UNION SELECT '<'
), costs AS MATERIALIZED (
  SELECT x.m AS a, y.m AS b, g1.u AS u, lower(g1.u[1]) AS letter, round(-ln({share}) * {pronounce.PART})::BIGINT AS cost
  FROM marks x CROSS JOIN marks y CROSS JOIN g1 LEFT JOIN g2 ON g2.b = y.m AND g2.u = g1.u LEFT JOIN g3 ON g3.a = x.m AND g3.b = y.m AND g3.u = g1.u
  LEFT JOIN s1 ON s1.b = y.m LEFT JOIN s2 ON s2.a = x.m AND s2.b = y.m
), asked AS ({words}
), walk AS (
  SELECT word, 1 AS k, '<' AS a, '<' AS b, 0::BIGINT AS cost, '' AS path FROM asked
  UNION ALL
  SELECT word, k, a, b, cost, path FROM (
    SELECT *, row_number() OVER (PARTITION BY word, a, b ORDER BY cost, path) AS place FROM (
      SELECT w.word, w.k + 1 AS k, CASE WHEN c.u IS NULL THEN w.a ELSE w.b END AS a, coalesce(c.u, w.b) AS b, w.cost + coalesce(c.cost, {pronounce.SKIP}) AS cost, w.path || coalesce(c.u || '|', '') AS path
      FROM walk w LEFT JOIN costs c ON c.a = w.a AND c.b = w.b AND c.letter = w.word[w.k] AND c.u <> '>' WHERE w.k <= length(w.word)
    )
  ) WHERE place = 1
), decoded AS (
  SELECT word, arg_min(path, (w.cost + c.cost, path)) AS path FROM walk w JOIN costs c ON c.a = w.a AND c.b = w.b AND c.u = '>' WHERE w.k = length(word) + 1 GROUP BY word
)"""


_TOKENS = "'[\\pL\\pM\\pN'']+|[^\\pL\\pM\\pN'']'"
LEARNED_WORDS = f"WITH RECURSIVE {UTT}, {_pronounce_sql("SELECT DISTINCT unnest(regexp_extract_all(lower(reading), '[a-z]+')) AS word FROM utts")} SELECT word, rtrim(path, '|') AS phones FROM decoded"
LEARNED_ARPA = f"""WITH RECURSIVE {UTT}, {_pronounce_sql(f"SELECT DISTINCT lower(unnest(regexp_extract_all(reading, {_TOKENS}))) AS word FROM utts")},
tk AS (SELECT utt_id, regexp_extract_all(reading, {_TOKENS}) AS l FROM utts), tp AS (SELECT utt_id, unnest(range(len(l))) AS pos, unnest(l) AS w FROM tk)
SELECT utt_id, array_to_string(flatten(list(CASE WHEN NOT regexp_matches(w, '[\\pL\\pM\\pN]') THEN [w] WHEN t.word IS NOT NULL THEN t.phones ELSE list_filter(string_split(d.path, '|'), lambda x: x <> '') END ORDER BY pos)), '|') AS phones
FROM tp LEFT JOIN taught t ON t.word = lower(w) LEFT JOIN decoded d ON d.word = lower(w) GROUP BY utt_id"""


# inflections: a made dictionary of stems and affixes

RULES = [
    Rule("S", "y", "ies", "[^aeiou]y"), Rule("S", "", "s", "[aeiou]y"), Rule("S", "", "es", "[sxzh]"), Rule("S", "", "s", "[^sxzhy]"),
    Rule("D", "", "d", "e"), Rule("D", "y", "ied", "[^aeiou]y"), Rule("D", "", "ed", "[^ey]"), Rule("G", "e", "ing", "e"), Rule("G", "", "ing", "[^e]", cross=False),
    Rule("U", "", "un", ".", suffix=False), Rule("R", "", "re", "[^e]", suffix=False), Rule("I", "l", "il", "l", suffix=False),
]


def stems(spark, sf_dir: str) -> DataFrame:
    """The benchmark's words less an s at the end; flags by their length and first letter."""
    word = F.regexp_replace("word", "s$", "")
    flags = F.when(F.length("word") % 3 == 0, F.array(F.lit("S"), F.lit("U"), F.lit("G"))).when(F.length("word") % 3 == 1, F.array(F.lit("S"), F.lit("D"), F.lit("R"))).otherwise(F.array(F.lit("I")))
    return base.lexicon(spark, sf_dir).select(word.alias("word"), flags.alias("flags")).where("word <> ''")


def q_accepted(spark, sf_dir):
    words = base.utterances(spark, sf_dir).select(F.explode(tx.stripped_words(F.col("reading"))).alias("word")).distinct()
    return accepted(saved(words), stems(spark, sf_dir), RULES)


def q_unknown_forms(spark, sf_dir):
    rows = base.utterances(spark, sf_dir)
    return filters.unknown_word_counts(rows, "reading", stems(spark, sf_dir), rules=RULES)


def _affix_sql() -> str:
    """known: the distinct words that are forms, all forms being listed here."""

    def made(rule: Rule, column: str) -> tuple[str, str]:
        """The form of a column's word, and whether its stem is such that the rule holds."""
        pattern = f"({rule.condition})$" if rule.suffix else f"^({rule.condition})"
        taken = f"left({column}, length({column}) - {len(rule.strip)}) || '{rule.add}'" if rule.suffix else f"'{rule.add}' || substr({column}, {len(rule.strip) + 1})"
        off = f"right(stem, {len(rule.strip)}) = '{rule.strip}'" if rule.suffix else f"left(stem, {len(rule.strip)}) = '{rule.strip}'"
        return taken, f"regexp_matches(stem, '{pattern}') AND {off}"

    ends = [(r, *made(r, "stem")) for r in RULES if r.suffix]
    starts = [(r, *made(r, "form")) for r in RULES if not r.suffix]
    parts = ["SELECT stem, flags, stem AS form, true AS crossed FROM stems"] + [f"SELECT stem, flags, {form}, {str(r.cross).lower()} FROM stems WHERE list_contains(flags, '{r.flag}') AND {cond}" for r, form, cond in ends]
    more = ["SELECT form FROM one"] + [f"SELECT {form} FROM one WHERE crossed AND list_contains(flags, '{r.flag}') AND {cond} AND (form = stem OR {str(r.cross).lower()})" for r, form, cond in starts]
    return f"""{base.LEX}, stems AS (
  SELECT regexp_replace(word, 's$', '') AS stem, list_distinct(flatten(list(CASE WHEN length(word) % 3 = 0 THEN ['S', 'U', 'G'] WHEN length(word) % 3 = 1 THEN ['S', 'D', 'R'] ELSE ['I'] END))) AS flags
  FROM lex WHERE regexp_replace(word, 's$', '') <> '' GROUP BY 1
), one AS ({" UNION ALL ".join(parts)}), forms AS (SELECT DISTINCT form FROM ({" UNION ALL ".join(more)})),
words AS (SELECT DISTINCT unnest({base.WORDS}) AS word FROM utts),
cased AS (SELECT word, lower(word) AS low, upper(left(word, 1)) || substr(lower(word), 2) AS title, upper(word) = word AND lower(word) <> word AS caps FROM words),
known AS (SELECT word FROM cased WHERE word IN (FROM forms) OR ((caps OR (word = title AND lower(word) <> word)) AND low IN (FROM forms)) OR (caps AND title IN (FROM forms)))"""


# sentence ends


def abridged(spark, sf_dir: str) -> DataFrame:
    """The utterances, with stops behind short words as abbreviations have them."""
    return base.utterances(spark, sf_dir).withColumn("reading", F.regexp_replace("reading", "(^| )(th|st|en|vi|de|on) ", "$1$2. "))


def q_abbreviations(spark, sf_dir):
    return sentence_ends.learn(abridged(spark, sf_dir), "reading").abbreviations.select("kind", F.round("score", 4).alias("score"))


def q_learned_sentences(spark, sf_dir):
    rows = abridged(spark, sf_dir)
    cut = sentence_ends.split(rows, "reading", sentence_ends.learn(rows, "reading"))
    return cut.select("utt_id", F.posexplode("sentences").alias("at", "sentence"))


_W = " \\t\\n\\x0B\\f\\r"
_bare = lambda t: f"trim({t}, {base.TRIM})"
_kind = lambda t: f"CASE WHEN regexp_full_match({_bare(t)}, '[0-9]+') THEN '{sentence_ends.NUMBER}' ELSE lower({_bare(t)}) END"
_part = lambda k, n, x: f"(CASE WHEN {k} > 0 THEN ({k}) * ln({x}) ELSE 0 END + CASE WHEN ({n}) - ({k}) > 0 THEN (({n}) - ({k})) * ln(1 - ({x})) ELSE 0 END)"
_OWN, _REST = ("n12", "n1", "n12 / n1::DOUBLE"), ("n2 - n12", "tokens - n1", "(n2 - n12) / (tokens - n1)::DOUBLE")
_RATIO = f"2 * ({_part(*_OWN)} + {_part(*_REST)} - {_part(*_OWN[:2], 'n2 / tokens::DOUBLE')} - {_part(*_REST[:2], 'n2 / tokens::DOUBLE')})"
ENDS = f"""ab AS (SELECT utt_id, regexp_replace(reading, '(^| )(th|st|en|vi|de|on) ', '\\1\\2. ', 'g') AS reading FROM utts),
tok AS (SELECT unnest(l) AS t, unnest(list_append(l[2:], NULL)) AS u FROM (SELECT regexp_extract_all(reading, '[^{_W}]+') AS l FROM ab)),
seen AS (SELECT {_kind('t')} AS kind, ends_with(t, '.') AS stop, regexp_matches({_bare('t')}, '^\\p{{Ll}}') AS small, CASE WHEN ends_with(t, '.') THEN {_kind('u')} END AS next_, regexp_matches({_bare('u')}, '^\\p{{Lu}}') AS capital, u IS NOT NULL AS more FROM tok),
kinds AS (SELECT kind, count(*) FILTER (stop) AS with_stop, count(*) FILTER (NOT stop) AS without, count(*) FILTER (small) AS small, count(*) AS all_ FROM seen GROUP BY kind),
sums AS (SELECT sum(all_)::DOUBLE AS tokens, sum(with_stop)::DOUBLE AS stops FROM kinds),
scored AS (SELECT kind, -2 * (with_stop * ln(stops / tokens) + without * ln(1 - stops / tokens) - with_stop * ln({sentence_ends.STOP}) - without * ln(1 - {sentence_ends.STOP}))
  * exp(-length(replace(kind, '.', ''))) * (length(kind) - length(replace(kind, '.', '')) + 1) * pow(length(replace(kind, '.', '')), -without) AS score FROM kinds, sums WHERE with_stop > 0 AND regexp_matches(kind, '\\p{{L}}')),
short AS (SELECT * FROM scored WHERE score >= {sentence_ends.LEAST_SCORE})"""
HELD = f"""pairs AS (SELECT kind, next_, capital, count(*) AS n FROM seen WHERE stop AND more GROUP BY ALL),
joined AS (SELECT p.*, short.kind IS NOT NULL AS is_short, sum(p.n) OVER (PARTITION BY p.kind, p.next_) AS n12, k.with_stop AS n1, m.all_ AS n2, m.small AS small, tokens
  FROM pairs p LEFT JOIN short ON short.kind = p.kind JOIN kinds k ON k.kind = p.kind JOIN kinds m ON m.kind = p.next_ CROSS JOIN sums),
held AS (SELECT kind, next_, capital FROM joined WHERE (is_short OR kind = '{sentence_ends.NUMBER}' OR regexp_full_match(kind, '\\p{{L}}'))
  AND (NOT capital OR small = 0 OR regexp_full_match(kind, '\\p{{L}}') OR (is_short AND n12 > 1 AND n12 / n1::DOUBLE > n2 / tokens AND {_RATIO} >= {sentence_ends.LEAST_RATIO}))),
cuts AS (SELECT utt_id, string_split(regexp_replace(reading, '([.!?])([{_W}]+)', '\\1' || chr(1) || '\\2' || chr(1), 'g'), chr(1)) AS p FROM ab),
each AS (SELECT utt_id, unnest(range(0, (len(p) + 1) // 2)) AS k, unnest(list_filter(p, lambda x, i: i % 2 = 1)) AS part, unnest(list_prepend('', list_filter(p, lambda x, i: i % 2 = 0))) AS white FROM cuts),
near AS (SELECT *, lag(part) OVER w AS before FROM each WINDOW w AS (PARTITION BY utt_id ORDER BY k)),
ends AS (SELECT *, {_kind(f"regexp_extract(before, '[^{_W}]*$')")} AS kind, {_kind(f"regexp_extract(part, '^[^{_W}]*')")} AS next_, regexp_matches({_bare(f"regexp_extract(part, '^[^{_W}]*')")}, '^\\p{{Lu}}') AS capital FROM near),
glued AS (SELECT e.utt_id, e.k, e.part, e.white, CASE WHEN e.k > 0 AND NOT (ends_with(before, '.') AND h.kind IS NOT NULL) THEN 1 ELSE 0 END AS fresh FROM ends e LEFT JOIN held h ON h.kind = e.kind AND h.next_ = e.next_ AND h.capital = e.capital),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY utt_id ORDER BY k) AS at_ FROM glued)"""


LEARNED = {
    "abbreviations": (q_abbreviations, f"WITH {UTT}, {ENDS} SELECT kind, round(score, 4) AS score FROM short"),
    "learned_sentences": (q_learned_sentences, f"""WITH {UTT}, {ENDS}, {HELD}
SELECT utt_id, at_::INT AS "at", string_agg(CASE WHEN fresh = 0 THEN white || part ELSE part END, '' ORDER BY k) AS sentence FROM numbered GROUP BY utt_id, at_"""),
    "inflected_words": (q_accepted, f"WITH {UTT}, {_affix_sql()} SELECT word FROM known"),
    "unknown_inflections": (q_unknown_forms, f"WITH {UTT}, {_affix_sql()}, w AS (SELECT utt_id, unnest({base.WORDS}) AS word FROM utts) SELECT utt_id, count(*)::BIGINT AS n_unknown FROM w WHERE word NOT IN (FROM known) GROUP BY utt_id"),
    "learned_pronunciations": (q_learned_words, LEARNED_WORDS),
    "learned_arpa": (q_learned_arpa, LEARNED_ARPA),
}
