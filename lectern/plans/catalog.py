"""Named queries over the driver's tables, and the same in DuckDB's SQL.

Utterances are the lines of `documents`; their ids keep the order of (doc_id, line). A fifth of the documents is selected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import phonetics as ph
from lectern.functions import text as tx
from lectern.operators import export, filters, greedy, selection, stats, transforms
from lectern.operators.ids import with_dense_ids
from lectern.operators.sentences import split_corpus
from lectern.plans.corpus import Corpus
from lectern.saving import saved_table
from lectern.sources.steps import selection_dataset

#: Ids of a document's lines.
LINES = 1 << 24
UNDESIRED = ("(", ")", "%", "@", "*", '"')
CHANGED = str.maketrans("aeiou", "ɑɛɪɔʊ")
VOWELS = {chr(a): chr(b) for a, b in CHANGED.items()}


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utterances(spark, sf_dir: str, ordered: bool = False) -> DataFrame:
    """ordered: dealt by ranges of doc_id and in the order of doc_id and line, as documents are sorted before they are cut."""
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "lang", "source", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id") if ordered else docs
    docs = docs.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n")).alias("line_nr", "reading"))
    return docs.where(~tx.is_blank(F.col("reading"))).select((F.col("doc_id") * LINES + F.col("line_nr")).alias("utt_id"), "doc_id", "lang", "source", "line_nr", "reading")


def with_symbols(rows: DataFrame) -> DataFrame:
    """The representation is the reading, as when a corpus is made."""
    symbols = tx.graphemes(F.col("reading"))
    return rows.withColumns({"reading_syms": symbols, "repr": F.col("reading"), "repr_syms": symbols})


def seed_ids(rows: DataFrame) -> DataFrame:
    return rows.where("doc_id % 5 = 0").select("utt_id", F.col("utt_id").alias("sel_rank"))


def corpus(spark, sf_dir: str) -> Corpus:
    """Paths are the documents' sources."""
    rows = utterances(spark, sf_dir)
    paths = table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("")).alias("path")).distinct().select(F.xxhash64("path").alias("path_id"), "path")
    made = with_symbols(rows.withColumn("path_id", F.xxhash64(F.coalesce("source", F.lit("")))))
    return Corpus(made, seed_ids(rows), paths)


def stat_rows(spark, sf_dir: str) -> DataFrame:
    rows = utterances(spark, sf_dir)
    return with_symbols(stats.flagged(rows, seed_ids(rows)))  # symbols behind the join, so that it shuffles texts


def lexicon(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.explode(tx.stripped_words(F.lower("text"))).alias("word")).distinct()


def kept(condition) -> object:
    return lambda spark, sf_dir: utterances(spark, sf_dir).where(~condition()).select("utt_id", "reading")


def q_utterances(spark, sf_dir):
    return with_dense_ids(utterances(spark, sf_dir).select("doc_id", "line_nr", "reading"), ["doc_id", "line_nr"]).select("utt_id", "doc_id", "line_nr", "reading")


def q_unknown_words(spark, sf_dir):
    rows = utterances(spark, sf_dir).where("lang = 'en'")
    return filters.without_unknown_words(rows, "reading", lexicon(spark, sf_dir), 5).select("utt_id", "reading")


def q_sentences(spark, sf_dir):
    return utterances(spark, sf_dir).select("utt_id", F.posexplode(transforms.split_sentences(F.col("reading"))).alias("at", "sentence"))


def q_arpa(spark, sf_dir):
    words = lexicon(spark, sf_dir).select("word", F.array(F.concat(F.lit("L"), F.lower("word"))).alias("phones"))
    rows = transforms.eng_to_arpa(utterances(spark, sf_dir).where("lang = 'en'"), "reading", words, "phones", spelled=lambda w: F.array(tx.upper_signs(w)))
    return rows.select("utt_id", F.array_join("phones", "|").alias("phones"))


def q_ngrams(n):
    def run(spark, sf_dir):
        return stats.ngram_stats(stat_rows(spark, sf_dir), n).select(F.array_join("ngram", "").alias("ngram"), "selected", "not_selected", "total", *[F.round(c, 6).alias(c) for c in ("selected_pct", "not_selected_pct", "total_pct")])

    return run


def q_inventory(spark, sf_dir):
    return stats.symbol_inventory(stat_rows(spark, sf_dir)).select("selected", F.array_join("symbols", "").alias("symbols"))


def new_ids(spark, sf_dir) -> DataFrame:
    """Other ids, in falling order."""
    return utterances(spark, sf_dir).where("doc_id % 3 = 0").select("utt_id", (-F.col("utt_id")).alias("sel_rank"))


def q_selection(how):
    def run(spark, sf_dir):
        return how(seed_ids(utterances(spark, sf_dir)), new_ids(spark, sf_dir)).select("utt_id", "sel_rank")

    return run


def q_merge(spark, sf_dir):
    first = corpus(spark, sf_dir)
    chats = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("utt_id"), F.lit(0).cast("long").alias("path_id"), F.col("turn").cast("int").alias("line_nr"), F.coalesce("text", F.lit("")).alias("reading"))
    second = Corpus(with_symbols(chats), chats.where("utt_id % 4 = 0").select("utt_id", F.col("utt_id").alias("sel_rank")), spark.createDataFrame([(0, "chats")], "path_id long, path string"))
    columns = ["utt_id", "path_id", "line_nr", "reading", "reading_syms", "repr", "repr_syms"]
    merged = selection.merge([second, first.with_(utterances=first.utterances.select(*columns))])
    marks = merged.selection.select("utt_id", F.lit(True).alias("mark"))
    return merged.utterances.join(marks, "utt_id", "left").join(merged.paths, "path_id", "left").select("utt_id", "reading", "path", F.coalesce("mark", F.lit(False)).alias("selected"))


def q_split_corpus(spark, sf_dir):
    made = split_corpus(corpus(spark, sf_dir))
    return made.utterances.join(made.selection.select("utt_id", F.lit(True).alias("mark")), "utt_id", "left").select("utt_id", "reading", F.coalesce("mark", F.lit(False)).alias("selected"))


def script_of(order, **options):
    def run(spark, sf_dir):
        c = corpus(spark, sf_dir)
        return export.script(c, export.in_order(c, order, **options)).select("Id", "Nr", "Utterance", "Path")

    return run


def q_tex_lines(spark, sf_dir):
    c = corpus(spark, sf_dir)
    return export.script(c, export.in_order(c)).select("Id", export.tex_item().alias("item"), export.numbered_line().alias("line"))


def rendered(spark, sf_dir) -> DataFrame:
    """The script of the whole selection, the last utterance first: a row for each document, in the order of part."""
    rows = utterances(spark, sf_dir).where("doc_id % 5 = 0").withColumnsRenamed({"reading": "Utterance", "utt_id": "Id"})
    items = rows.select((-F.col("doc_id")).alias("part"), F.struct((-F.col("Id")).alias("o"), F.concat(export.tex_item(), F.lit("\n")).alias("item")).alias("line"))
    return items.groupBy("part").agg(F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["item"]), "").alias("value"))


def q_textgrid(spark, sf_dir):
    """All lines of the script are of selected documents, so only their texts are read."""
    c = corpus(spark, sf_dir)
    return _intervals(export.textgrid(c.with_(utterances=c.utterances.where("doc_id % 5 = 0")), rendered(spark, sf_dir), part="part"))


def _intervals(grid: DataFrame) -> DataFrame:
    return grid.select("tier", "idx", F.round("min_t", 6).alias("min_t"), F.round("max_t", 6).alias("max_t"), "mark")


def q_prep(spark, sf_dir):
    """The filters of the preparing pipeline, each on what the one before left."""
    r = F.col("reading")
    rows = utterances(spark, sf_dir).where(~filters.has_acronym(r))
    rows = saved_table(filters.first_of_duplicates(rows, "reading").select("utt_id", "reading"))  # read several times
    rows = filters.without_rare_words(rows, "reading", 2)
    return rows.where(~filters.has_undesired(r, UNDESIRED) & ~filters.word_count_outside(r, 3)).select("utt_id", "reading")


def q_kld_step(spark, sf_dir):
    """The divergence that each candidate would lead to: one step of the greedy selection, after a fifth is selected."""
    rows = with_symbols(utterances(spark, sf_dir))
    each = greedy.kld_scores(rows, seed_ids(rows), 1)
    return each.select("utt_id", F.round("kld", 6).alias("kld"))


def q_greedy(kind):
    def run(spark, sf_dir):
        c = corpus(spark, sf_dir)
        return greedy.greedy(c.utterances, c.selection, kind, 1, 60.0, ignore={" "}, band=(3.0, 5.0))

    return run


def gram_kinds(n: int = 1, ignore: str = " ", rows: str = "utts") -> str:
    """CTEs in SQL: kinds of n-grams numbered from 1, and each row's kinds with counts."""
    each = f"list_transform(range(1, length(t) - {n - 2}), lambda i: substr(t, i, {n}))"
    return f"""gx AS (SELECT utt_id, unnest({each}) AS gram FROM (SELECT utt_id, replace(reading, '{ignore}', '') AS t FROM {rows})),
gk AS (SELECT gram, row_number() OVER (ORDER BY gram)::INT AS k FROM (SELECT DISTINCT gram FROM gx)),
gu AS (SELECT utt_id, list(struct_pack(k := k, c := c) ORDER BY k) AS g, sum(c)::DOUBLE AS n FROM (SELECT utt_id, k, count(*)::DOUBLE AS c FROM gx JOIN gk USING (gram) GROUP BY ALL) GROUP BY utt_id)"""


def greedy_steps(kind: str, name: str, chosen: str, where: str, seconds: float, speed: float = 13.7) -> str:
    """CTEs of one greedy selection, on gram_kinds: NAME has step and utt_id. chosen: a table with the utt_id selected before; where: which rows of utts are candidates.

    A step is a row: the counts of all kinds, the seconds left, the ids taken.
    """
    if kind == "kld":
        gain = "list_sum(list_transform(x.g, lambda p: (s.have[p.k] + p.c) * ln(s.have[p.k] + p.c) - CASE WHEN s.have[p.k] > 0 THEN s.have[p.k] * ln(s.have[p.k]) ELSE 0 END))"
        base = "coalesce(list_sum(list_transform(s.have, lambda h: CASE WHEN h > 0 THEN h * ln(h) ELSE 0 END)), 0)"
        score = f"round(({base} + {gain}) / (list_sum(s.have) + x.n) - ln(list_sum(s.have) + x.n), 12)"
        anew = "false"
    else:
        score = "-len(list_filter(x.g, lambda p: s.have[p.k] = 0))::DOUBLE"
        anew = "best.score = 0 AND list_sum(have) > 0"
    more = "list_transform(range(1, len(have) + 1), lambda i: have[i] + coalesce(list_sum(list_transform(list_filter(best.x.g, lambda p: p.k = i), lambda p: p.c)), 0))"
    return f"""{name}_have AS (SELECT list(coalesce(c, 0)::DOUBLE ORDER BY gk.k) AS have FROM gk LEFT JOIN (SELECT p.k AS k, sum(p.c) AS c FROM (SELECT unnest(g) AS p FROM gu WHERE utt_id IN (SELECT utt_id FROM {chosen})) GROUP BY p.k) h USING (k)),
{name}_rows AS (SELECT coalesce(list(struct_pack(id := utt_id, n := gu.n, g := g, dur := length(reading) / {speed}::DOUBLE) ORDER BY utt_id), []) AS cands FROM utts JOIN gu USING (utt_id) WHERE utt_id NOT IN (SELECT utt_id FROM {chosen}) AND {where}),
{name}_loop AS (SELECT 0 AS step, have, {seconds}::DOUBLE AS room, []::BIGINT[] AS taken, false AS done FROM {name}_have
UNION ALL
SELECT step + 1, CASE WHEN {anew} THEN list_transform(have, lambda h: 0::DOUBLE) WHEN best.x.dur > room + 1e-9 THEN have ELSE {more} END,
CASE WHEN {anew} OR best.x.dur > room + 1e-9 THEN room ELSE room - best.x.dur END, CASE WHEN {anew} OR best.x.dur > room + 1e-9 THEN taken ELSE list_append(taken, best.x.id) END, NOT ({anew}) AND best.x.dur > room + 1e-9
FROM (SELECT s.step, s.have, s.room, s.taken, list_min(list_transform(list_filter(r.cands, lambda x: NOT list_contains(s.taken, x.id)), lambda x: struct_pack(score := {score}, id := x.id, x := x))) AS best
FROM {name}_loop s, {name}_rows r WHERE NOT s.done) WHERE best IS NOT NULL),
{name} AS (SELECT unnest(taken) AS utt_id, unnest(range(len(taken))) AS step FROM (SELECT taken FROM {name}_loop ORDER BY step DESC LIMIT 1))"""


def greedy_sql(kind: str, n: int = 1) -> str:
    band = "length(reading) / 13.7::DOUBLE >= 3 AND length(reading) / 13.7::DOUBLE < 5"
    return f"WITH RECURSIVE {UTT}, {SEL}, {gram_kinds(n)}, {greedy_steps(kind, 'picked', 'sel', band, 60.0)} SELECT utt_id, step AS sel_rank FROM picked"


TRIM = """'.,;-/!?:\\—()[]{}"'''"""
UTT = f"""lines AS (SELECT doc_id, lang, source, unnest(l) AS reading, unnest(range(len(l))) AS line_nr FROM (SELECT *, string_split(text, chr(10)) AS l FROM documents)),
utts AS (SELECT doc_id * {LINES} + line_nr AS utt_id, doc_id, lang, source, line_nr, reading FROM lines WHERE NOT regexp_full_match(reading, '\\s*'))"""
WORDS = f"list_filter(list_transform(string_split(reading, ' '), lambda w: trim(w, {TRIM})), lambda w: w <> '')"
LOW_WORDS = f"string_split(array_to_string(list_filter(list_transform(string_split(lower(reading), ' '), lambda w: trim(w, {TRIM})), lambda w: w <> ''), ' '), ' ')"
SEL = "sel AS (SELECT utt_id FROM utts WHERE doc_id % 5 = 0)"
NEW = "new AS (SELECT utt_id, -utt_id AS o FROM utts WHERE doc_id % 3 = 0)"
STAT = f"rows_ AS (SELECT *, doc_id % 5 = 0 AS selected, length(reading) AS n FROM utts)"
LEX = f"lex AS (SELECT DISTINCT unnest(list_filter(list_transform(string_split(lower(text), ' '), lambda w: trim(w, {TRIM})), lambda w: w <> '')) AS word FROM benchmark)"


def _where(condition: str) -> str:
    return f"WITH {UTT} SELECT utt_id, reading FROM utts WHERE {condition}"


def _ngram_sql(n: int) -> str:
    return f"""WITH {UTT}, {STAT}, g AS (SELECT selected, unnest(list_transform(range(1, n - {n - 2}), lambda i: substr(reading, i, {n}))) AS ngram FROM rows_),
c AS (SELECT ngram, (count(*) FILTER (selected))::BIGINT AS selected, (count(*) FILTER (NOT selected))::BIGINT AS not_selected, count(*)::BIGINT AS total FROM g GROUP BY ngram)
SELECT ngram, selected, not_selected, total, round(100 * selected / sum(selected) OVER (), 6)::DOUBLE AS selected_pct, round(100 * not_selected / sum(not_selected) OVER (), 6)::DOUBLE AS not_selected_pct, round(100 * total / sum(total) OVER (), 6)::DOUBLE AS total_pct FROM c"""


ITEM = "'  \\item ' || CASE WHEN right(reading, 1) IN ('!', '?') THEN right(reading, 1) || ' ' ELSE '' END || reading || ' % ' || utt_id"
_script_sql = lambda order: f"""WITH {UTT}, s AS (SELECT *, row_number() OVER (ORDER BY {order}) AS nr, count(*) OVER () AS n FROM utts WHERE doc_id % 5 = 0)
SELECT utt_id AS Id, lpad(nr::VARCHAR, length(n::VARCHAR)::INT, '0') AS Nr, reading AS Utterance, source AS Path FROM s"""  # noqa: E731
_ACRONYM = f"len(list_filter({WORDS}, lambda w: length(w) >= 3 AND upper(w) = w AND lower(w) <> w)) > 0"
_UNDESIRED = " OR ".join(f"contains(lower(reading), '{u}')" for u in UNDESIRED)
_RARE = f"""f AS (SELECT w, count(*) AS n FROM (SELECT unnest({LOW_WORDS}) AS w FROM BASE) GROUP BY w),
bad AS (SELECT DISTINCT utt_id FROM (SELECT utt_id, unnest({LOW_WORDS}) AS w FROM BASE) JOIN f USING (w) WHERE n < 2)"""

#: name: (query, SQL or None where SQL can't express it)
CATALOG = {
    "utterances": (q_utterances, f"WITH {UTT} SELECT row_number() OVER (ORDER BY doc_id, line_nr) - 1 AS utt_id, doc_id, line_nr::INT AS line_nr, reading FROM utts"),
    "dedupe_first": (lambda s, d: filters.first_of_duplicates(utterances(s, d), "reading").select("utt_id", "reading"), f"WITH {UTT} SELECT min(utt_id) AS utt_id, reading FROM utts GROUP BY reading"),
    "filter_acronyms": (kept(lambda: filters.has_acronym(F.col("reading"))), _where(f"NOT ({_ACRONYM})")),
    "filter_proper_names": (lambda s, d: utterances(s, d).where("lang = 'en'").where(~filters.has_proper_name(F.col("reading"))).select("utt_id", "reading"), _where(f"lang = 'en' AND NOT regexp_matches(array_to_string({WORDS}, ' '), ' [A-HJ-Z]')")),
    "filter_undesired_text": (kept(lambda: filters.has_undesired(F.col("reading"), UNDESIRED)), _where(f"NOT ({_UNDESIRED})")),
    "filter_word_count": (kept(lambda: filters.word_count_outside(F.col("reading"), 3, 40)), _where("len(string_split(reading, ' ')) BETWEEN 3 AND 40")),
    "filter_unknown_words": (q_unknown_words, f"""WITH {UTT}, {LEX}, w AS (SELECT utt_id, unnest({WORDS}) AS w FROM utts WHERE lang = 'en'),
bad AS (SELECT utt_id FROM w WHERE w NOT IN (SELECT word FROM lex) AND lower(w) NOT IN (SELECT word FROM lex) GROUP BY utt_id HAVING count(*) > 5)
SELECT utt_id, reading FROM utts WHERE lang = 'en' AND utt_id NOT IN (SELECT utt_id FROM bad)"""),
    "filter_rare_words": (lambda s, d: filters.without_rare_words(utterances(s, d), "reading", 2).select("utt_id", "reading"), f"WITH {UTT}, {_RARE.replace('BASE', 'utts')} SELECT utt_id, reading FROM utts WHERE utt_id NOT IN (SELECT utt_id FROM bad)"),
    "filter_is_sentence": (lambda s, d: utterances(s, d).where(filters.is_sentence(F.col("reading"))).select("utt_id", "reading"), _where("upper(left(reading, 1)) = left(reading, 1) AND lower(left(reading, 1)) <> left(reading, 1) AND right(reading, 1) IN ('.', '!', '?')")),
    "filter_duration_band": (lambda s, d: with_symbols(utterances(s, d)).where(filters.in_duration_band(F.col("reading_syms"), 3.0, 5.0)).select("utt_id", "reading"), _where("length(reading) / 13.7 >= 3 AND length(reading) / 13.7 < 5")),
    "split_sentences": (q_sentences, f"WITH {UTT}, x AS (SELECT utt_id, string_split(regexp_replace(reading, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS l FROM utts) SELECT utt_id, unnest(range(len(l)))::INT AS at, unnest(l) AS sentence FROM x"),
    "split_corpus": (q_split_corpus, f"""WITH {UTT}, x AS (SELECT utt_id AS old, doc_id, string_split(regexp_replace(reading, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)) AS l FROM utts),
y AS (SELECT old, doc_id, unnest(range(len(l))) AS k, unnest(l) AS reading FROM x)
SELECT row_number() OVER (ORDER BY old, k) - 1 AS utt_id, reading, doc_id % 5 = 0 AS selected FROM y WHERE NOT regexp_full_match(reading, '\\s*')"""),
    "replace_text": (lambda s, d: utterances(s, d).select("utt_id", transforms.replace(F.col("reading"), "the", "THE").alias("reading")), f"WITH {UTT} SELECT utt_id, replace(reading, 'the', 'THE') AS reading FROM utts"),
    "normalize_text": (lambda s, d: utterances(s, d).select("utt_id", transforms.normalize(F.col("reading")).alias("reading")), f"""WITH {UTT} SELECT utt_id, trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize(reading), '[\\x00-\\x08\\x0e-\\x1f\\x7f]', '', 'g'),
'[“”„«»]', '"', 'g'), '[‘’‚‹›]', '''', 'g'), '[‐‑‒–—]', '-', 'g'), '…', '...'), '[ \\t\\n\\x0b\\f\\r\\x{{a0}}]+', ' ', 'g'), ' ') AS reading FROM utts"""),
    "change_text": (lambda s, d: utterances(s, d).select("utt_id", transforms.tighten_punctuation(F.col("reading")).alias("reading")), f"WITH {UTT} SELECT utt_id, regexp_replace(reading, ' *([.,;:!?…]) *', '\\1', 'g') AS reading FROM utts"),
    "map_symbols": (lambda s, d: utterances(s, d).select("utt_id", tx.symbols_text(ph.map_symbols(tx.graphemes(F.col("reading")), VOWELS)).alias("symbols")), f"WITH {UTT} SELECT utt_id, translate(reading, '{''.join(VOWELS)}', '{''.join(VOWELS.values())}') AS symbols FROM utts"),
    "eng_to_arpa": (q_arpa, f"""WITH {UTT}, {LEX}, t AS (SELECT utt_id, regexp_extract_all(reading, '[\\pL\\pM\\pN'']+|[^\\pL\\pM\\pN'']') AS l FROM utts WHERE lang = 'en'),
p AS (SELECT utt_id, unnest(range(len(l))) AS k, unnest(l) AS w FROM t)
SELECT utt_id, string_agg(CASE WHEN NOT regexp_matches(w, '[\\pL\\pM\\pN]') THEN w WHEN word IS NOT NULL THEN 'L' || word ELSE upper(lower(w)) END, '|' ORDER BY k) AS phones FROM p LEFT JOIN lex ON lower(w) = word GROUP BY utt_id"""),
    "stripped_text": (lambda s, d: utterances(s, d).select("utt_id", tx.stripped_text(F.col("reading")).alias("text")), f"WITH {UTT} SELECT utt_id, array_to_string({WORDS}, ' ') AS text FROM utts"),
    "word_frequency": (lambda s, d: filters.word_frequencies(utterances(s, d), "reading"), f"WITH {UTT} SELECT w AS word, count(*)::BIGINT AS frequency FROM (SELECT unnest({LOW_WORDS}) AS w FROM utts) GROUP BY w"),
    **{f"ngram_stats_{n}": (q_ngrams(n), _ngram_sql(n)) for n in (1, 2, 3)},
    "general_stats": (lambda s, d: stats.general_stats(stat_rows(s, d)), f"""WITH {UTT}, {STAT}, x AS (SELECT selected, n, len(string_split(reading, ' ')) AS w FROM rows_)
SELECT selected, count(*)::BIGINT AS entries, sum(n)::BIGINT AS symbols, min(w)::INT AS words_min, round(avg(w), 6) AS words_mean, median(w)::DOUBLE AS words_median, max(w)::INT AS words_max,
round(min(n) / 13.7, 6)::DOUBLE AS seconds_min, round(avg(n) / 13.7, 6)::DOUBLE AS seconds_mean, round(median(n) / 13.7, 6)::DOUBLE AS seconds_median, round(max(n) / 13.7, 6)::DOUBLE AS seconds_max, round(sum(n)::DOUBLE / 13.7 / 60, 6) AS minutes, round(sum(n)::DOUBLE / 13.7 / 3600, 6) AS hours FROM x GROUP BY selected"""),
    "duration_histogram": (lambda s, d: stats.duration_histogram(with_symbols(utterances(s, d))), f"""WITH {UTT}, h AS (SELECT round_even(length(reading)::DOUBLE / 13.7::DOUBLE, 0)::BIGINT AS second, count(*)::BIGINT AS utterances FROM utts GROUP BY 1), t AS (SELECT *, second * utterances AS seconds FROM h)
SELECT second, utterances, seconds, round(100 * seconds::DOUBLE / sum(seconds) OVER (), 6) AS pct, round(100 * (sum(seconds) OVER (ORDER BY second))::DOUBLE / sum(seconds) OVER (), 6) AS running_pct FROM t"""),
    "symbol_inventory": (q_inventory, f"WITH {UTT}, {STAT} SELECT selected, string_agg(s, '' ORDER BY s) AS symbols FROM (SELECT DISTINCT selected, unnest(string_split(reading, '')) AS s FROM rows_) GROUP BY selected"),
    "removal_stats": (lambda s, d: stats.removal_stats(utterances(s, d), utterances(s, d).where(~filters.has_acronym(F.col("reading")))), f"WITH {UTT} SELECT (count(*) FILTER ({_ACRONYM}))::BIGINT AS removed, (count(*) FILTER (NOT ({_ACRONYM})))::BIGINT AS kept, round(100 * (count(*) FILTER ({_ACRONYM})) / count(*), 6)::DOUBLE AS removed_pct FROM utts"),
    "selection_change": (lambda s, d: (lambda u: stats.selection_change(seed_ids(u), u.where("doc_id % 3 = 0")))(utterances(s, d)), f"WITH {UTT} SELECT (count(*) FILTER (doc_id % 3 = 0 AND doc_id % 5 <> 0))::BIGINT AS added, (count(*) FILTER (doc_id % 5 = 0 AND doc_id % 3 <> 0))::BIGINT AS removed, (count(*) FILTER (doc_id % 15 = 0))::BIGINT AS kept FROM utts"),
    "distinct_counts": (lambda s, d: stats.distinct_counts(utterances(s, d), "reading"), f"WITH {UTT} SELECT count(DISTINCT reading)::BIGINT AS texts, (SELECT count(DISTINCT w) FROM (SELECT unnest({LOW_WORDS}) AS w FROM utts) WHERE w <> '')::BIGINT AS words FROM utts"),
    "preview": (lambda s, d: stats.preview(with_symbols(utterances(s, d))), f"WITH {UTT} SELECT utt_id, reading AS repr, (n - 10)::BIGINT AS further FROM (SELECT *, count(*) OVER () AS n FROM utts) ORDER BY utt_id LIMIT 10"),
    "selected_semi": (lambda s, d: corpus(s, d).selected().select("utt_id", "reading"), _where("doc_id % 5 = 0")),
    "deselected_anti": (lambda s, d: corpus(s, d).deselected().select("utt_id", "reading"), _where("doc_id % 5 <> 0")),
    "selection_union": (q_selection(selection.add), f"WITH {UTT}, {SEL}, {NEW}, b AS (SELECT utt_id, 0 AS p, utt_id AS o FROM sel UNION ALL SELECT utt_id, 1, o FROM new WHERE utt_id NOT IN (SELECT utt_id FROM sel)) SELECT utt_id, row_number() OVER (ORDER BY p, o) - 1 AS sel_rank FROM b"),
    "selection_remove": (q_selection(selection.remove), f"WITH {UTT}, {SEL}, {NEW} SELECT utt_id, row_number() OVER (ORDER BY utt_id) - 1 AS sel_rank FROM sel WHERE utt_id NOT IN (SELECT utt_id FROM new)"),
    "select_replace": (q_selection(selection.select), f"WITH {UTT}, {SEL}, {NEW}, b AS (SELECT utt_id, 0 AS p, utt_id AS o FROM sel WHERE utt_id IN (SELECT utt_id FROM new) UNION ALL SELECT utt_id, 1, o FROM new WHERE utt_id NOT IN (SELECT utt_id FROM sel)) SELECT utt_id, row_number() OVER (ORDER BY p, o) - 1 AS sel_rank FROM b"),
    "selection_dataset": (lambda s, d: selection_dataset(corpus(s, d)), f"WITH {UTT} SELECT utt_id, CASE WHEN doc_id % 5 = 0 THEN 'Selected' ELSE 'Available' END AS subset, 1.0::DOUBLE AS weight FROM utts"),
    "merge_corpora": (q_merge, f"""WITH {UTT}, b AS (SELECT 0 AS c, conv_id * 1000 + turn AS o, coalesce(text, '') AS reading, 'chats' AS path, (conv_id * 1000 + turn) % 4 = 0 AS selected FROM conversations UNION ALL SELECT 1, utt_id, reading, source, doc_id % 5 = 0 FROM utts)
SELECT row_number() OVER (ORDER BY c, o) - 1 AS utt_id, reading, path, selected FROM b"""),
    "export_by_index": (script_of("by_index"), _script_sql("utt_id")),
    "export_by_selection": (script_of("by_selection"), _script_sql("utt_id")),
    "export_by_symbol_count": (script_of("symbol_count_asc"), _script_sql("length(reading), utt_id")),
    "export_random": (script_of("random"), _script_sql(f"md5('{export.SEED}:' || utt_id)")),
    "export_deselected": (lambda s, d: (lambda c: export.script(c, export.deselected_order(c)).select("Id", "Nr", "Utterance"))(corpus(s, d)), f"WITH {UTT}, x AS (SELECT *, row_number() OVER (ORDER BY utt_id) AS nr, count(*) OVER () AS n FROM utts WHERE doc_id % 5 <> 0) SELECT utt_id AS Id, lpad(nr::VARCHAR, length(n::VARCHAR)::INT, '0') AS Nr, reading AS Utterance FROM x"),
    "export_tex_lines": (q_tex_lines, f"WITH {UTT}, x AS (SELECT *, row_number() OVER (ORDER BY utt_id) AS nr, count(*) OVER () AS n FROM utts WHERE doc_id % 5 = 0) SELECT utt_id AS Id, {ITEM} AS item, lpad(nr::VARCHAR, length(n::VARCHAR)::INT, '0') || ': ' || reading AS line FROM x"),
    "tex_ids": (lambda s, d: selection.tex_ids(rendered(s, d), part="part"), f"WITH {UTT} SELECT utt_id, row_number() OVER (ORDER BY utt_id DESC) - 1 AS sel_rank FROM utts WHERE doc_id % 5 = 0"),
    "textgrid_intervals": (q_textgrid, f"""WITH {UTT}, s AS (SELECT *, row_number() OVER (ORDER BY utt_id DESC) - 1 AS idx, length(reading) AS n, sum(length(reading)) OVER (ORDER BY utt_id DESC) AS upto FROM utts WHERE doc_id % 5 = 0)
SELECT tier, idx::BIGINT AS idx, round((upto - n)::DOUBLE / 13.7, 6) AS min_t, round(upto::DOUBLE / 13.7, 6) AS max_t, reading AS mark FROM s, (VALUES ('sentences (graphemes)'), ('sentences (phonemes)')) v(tier)"""),
    "prep_pipeline": (q_prep, f"""WITH {UTT}, a AS (SELECT * FROM utts WHERE NOT ({_ACRONYM})), b AS (SELECT min(utt_id) AS utt_id, reading FROM a GROUP BY reading), {_RARE.replace('BASE', 'b')}
SELECT utt_id, reading FROM b WHERE utt_id NOT IN (SELECT utt_id FROM bad) AND NOT ({_UNDESIRED}) AND len(string_split(reading, ' ')) >= 3"""),
    "kld_step_scores": (q_kld_step, f"""WITH {UTT}, g AS (SELECT utt_id, doc_id % 5 = 0 AS sel, s, count(*) AS n FROM (SELECT utt_id, doc_id, unnest(string_split(reading, '')) AS s FROM utts) GROUP BY ALL),
h AS (SELECT s, sum(n)::DOUBLE AS x FROM g WHERE sel GROUP BY s), t AS (SELECT sum(x) AS nx, sum(x * ln(x)) AS sx FROM h), v AS (SELECT count(DISTINCT s) AS v FROM g),
c AS (SELECT utt_id, sum(n)::DOUBLE AS n, sum((coalesce(x, 0) + n) * ln(coalesce(x, 0) + n) - CASE WHEN x > 0 THEN x * ln(x) ELSE 0 END) AS gain FROM g LEFT JOIN h USING (s) WHERE NOT sel GROUP BY utt_id)
SELECT utt_id, round(ln(v) - ln(nx + n) + (sx + gain) / (nx + n), 6) AS kld FROM c, t, v"""),
    "select_kld": (q_greedy("kld"), greedy_sql("kld")),
    "select_greedy": (q_greedy("coverage"), greedy_sql("coverage")),
}
