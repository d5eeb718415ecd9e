"""Commands on corpora: every command reads one step of a corpus and writes another.

    python -m lectern.cli VERB BASE_DIR CORPUS STEP [OUT_STEP] [options]

A step is a folder BASE_DIR/CORPUS/STEP of Parquet tables. Without an out step, filters, changes and selections replace
the step that they read, at once, when all of the new one is written.
"""

from __future__ import annotations

import argparse
import math
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lectern.functions import phonetics as ph
from lectern.operators import export, filters, greedy, pronounce, sentence_ends, stats, transforms
from lectern.operators import selection as sel
from lectern.operators.affixes import read_dictionary
from lectern.operators.sentences import split_corpus
from lectern.plans import pipelines
from lectern.plans.corpus import Corpus
from lectern.sources import steps
from lectern.sources.text_files import ingest, read_tex


def parse_set(text: str, by: str) -> set[str]:
    """The parts of a text, without empty ones."""
    return {x for x in text.split(by) if x}


def lexicon_of(spark, path: str):
    """Words of a text file, one a line; with a tab and phones behind, those too."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(F.lower(F.element_at(parts, 1)).alias("word"), F.split(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), " ").alias("phones"))


def _target(p):
    p.add_argument("--target", choices=("reading", "repr", "both"), default="repr")


def _band(p):
    p.add_argument("--n_gram", type=int, default=1)
    p.add_argument("--minutes", type=float, required=True)
    p.add_argument("--reading_speed", type=float, default=13.7)
    p.add_argument("--ignore_symbols", default="")
    p.add_argument("--boundary_min", type=float, default=0.0)
    p.add_argument("--boundary_max", type=float, default=math.inf)


def _greedy(kind: str) -> Callable:
    return lambda s, c, a: greedy.select_greedy(c, kind, a.n_gram, a.minutes, ignore=parse_set(a.ignore_symbols, "&"), band=(a.boundary_min, a.boundary_max), speed=a.reading_speed)


def _arpa(spark, c: Corpus, a) -> Corpus:
    """Words that the lexicon lacks are said as a model learned from it says, or by rules of spelling."""
    lexicon = lexicon_of(spark, a.lexicon)
    return pipelines.to_arpa(c, lexicon, a.target, pronounce.learn(lexicon).phones if a.fallback == "learned" else ph.spelled_phones)


def _unknown(spark, c: Corpus, a) -> Corpus:
    lexicon, rules = read_dictionary(spark, a.lexicon, a.affixes) if a.affixes else (lexicon_of(spark, a.lexicon), None)
    return pipelines.remove_unknown_words(c, lexicon, a.max_unknown_word_count, rules)


def _order(p):
    p.add_argument("--sorting_mode", choices=export.ORDERS, default="by_index")
    p.add_argument("--seed", type=int, default=export.SEED)
    p.add_argument("--ignore_symbols", default="")
    p.add_argument("--parts_count", type=int, default=1)
    p.add_argument("--take_per_part", type=int, default=1)
    p.add_argument("--out_dir", required=True)


def _adds(*args: tuple) -> Callable:
    def add(p):
        for name, options in args:
            p.add_argument(name, **options)

    return add


r = lambda: F.col("repr")
n = {"type": int}

#: verb: (options, change of a corpus)
CHANGES: dict[str, tuple[Callable, Callable]] = {
    "load-selection": (_adds(("--dataset", {"required": True})), lambda s, c, a: steps.load_selection(c, s.read.parquet(a.dataset))),
    "split-sentences": (_adds(("--strict", {"action": "store_true"}), ("--ends", {"choices": ("learned", "signs"), "default": "learned"})), lambda s, c, a: split_corpus(c, a.strict, sentence_ends.learn(c.utterances, "reading") if a.ends == "learned" else None)),
    "normalize": (_target, lambda s, c, a: c.map(a.target, transforms.normalize)),
    "replace": (lambda p: (_target(p), p.add_argument("--replace_target", required=True), p.add_argument("--replace_with", default="")), lambda s, c, a: c.map(a.target, lambda t: transforms.replace(t, a.replace_target, a.replace_with))),
    "change-text": (lambda p: (_target(p), p.add_argument("--remove_space_around_punctuation", action="store_true")), lambda s, c, a: c.map(a.target, transforms.tighten_punctuation if a.remove_space_around_punctuation else lambda t: t)),
    "eng-to-arpa": (lambda p: (_target(p), p.add_argument("--lexicon", required=True), p.add_argument("--fallback", choices=("learned", "rules"), default="learned")), _arpa),
    "to-symbols": (_target, lambda s, c, a: c.map(a.target, lambda t: t)),
    "arpa-to-ipa": (_target, lambda s, c, a: pipelines.to_ipa(c, a.target)),
    "change-ipa": (
        lambda p: (_target(p), *(p.add_argument(f"--{x}", action="store_true") for x in ("ignore_tones", "ignore_arcs", "ignore_stress", "break_n_thongs", "build_n_thongs"))),
        lambda s, c, a: c.map_symbols(a.target, lambda t: ph.change_ipa(t, a.ignore_tones, a.ignore_arcs, a.ignore_stress, a.break_n_thongs, a.build_n_thongs)),
    ),
    "remove-deselected": (_adds(), lambda s, c, a: sel.remove_deselected(c)),
    "remove-text": (_adds(("--undesired", {"required": True})), lambda s, c, a: c.remove(filters.has_undesired(r(), parse_set(a.undesired, "|")))),
    "remove-duplicates": (_adds(), lambda s, c, a: pipelines.remove_duplicates(c)),
    "remove-proper-names": (_adds(), lambda s, c, a: c.remove(filters.has_proper_name(r(), c.language))),
    "remove-acronyms": (_adds(("--min_acronym_len", n | {"default": 3})), lambda s, c, a: c.remove(filters.has_acronym(r(), a.min_acronym_len))),
    "remove-word-counts": (_adds(("--min_count", n), ("--max_count", n)), lambda s, c, a: c.remove(filters.word_count_outside(r(), a.min_count, a.max_count))),
    "remove-unknown-words": (_adds(("--max_unknown_word_count", n | {"required": True}), ("--lexicon", {"required": True}), ("--affixes", {"help": "the lexicon is a .dic file, and this its .aff file"})), _unknown),
    "remove-rare-words": (_adds(("--min_occurrence_count", n | {"required": True})), lambda s, c, a: pipelines.remove_rare_words(c, a.min_occurrence_count)),
    "select-from-tex": (_adds(("--tex", {"required": True})), lambda s, c, a: sel.select_from_tex(c, read_tex(s, a.tex))),
    "select-greedy-duration": (_band, _greedy("coverage")),
    "select-kld-duration": (_band, _greedy("kld")),
    "select-all": (_adds(), lambda s, c, a: sel.select_all(c)),
    "deselect-all": (_adds(), lambda s, c, a: sel.deselect_all(c)),
}


def _stats(spark, c: Corpus, a) -> None:
    rows = stats.flagged(c.utterances, c.selection)
    for k in (1, 2, 3):
        stats.write_ngram_csv(rows, k, a.out_dir)
    for table in (stats.general_stats(rows), stats.duration_histogram(rows).orderBy("second"), stats.symbol_inventory(rows)):
        table.show(1000, truncate=False)


def _selected(spark, c: Corpus, a) -> None:
    order = export.in_order(c, a.sorting_mode, a.seed, parse_set(a.ignore_symbols, "&"), a.parts_count, a.take_per_part)
    export.write_scripts(export.script(c, order), a.out_dir, "selected")


def _textgrid(spark, c: Corpus, a) -> None:
    export.write_textgrid(export.textgrid(c, read_tex(spark, a.tex), speed=a.reading_speed), a.out)


#: verb: (options, what is written from a corpus)
OUTPUTS: dict[str, tuple[Callable, Callable]] = {
    "save-selection": (_adds(("--dataset", {"required": True})), lambda s, c, a: steps.selection_dataset(c).write.mode("overwrite").parquet(a.dataset)),
    "stats": (_adds(("--out_dir", {"required": True})), _stats),
    "gen-selected-script": (_order, _selected),
    "gen-deselected-script": (_adds(("--out_dir", {"required": True}), ("--only_txt", {"action": "store_true"})), lambda s, c, a: export.write_scripts(export.script(c, export.deselected_order(c)), a.out_dir, "deselected", a.only_txt)),
    "gen-textgrid": (_adds(("--tex", {"required": True}), ("--out", {"required": True}), ("--reading_speed", {"type": float, "default": 13.7})), _textgrid),
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="lectern", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    verbs = out.add_subparsers(dest="verb", required=True)

    def verb(name: str, options: Callable) -> argparse.ArgumentParser:
        p = verbs.add_parser(name)
        for x in ("base_dir", "corpus", "step"):
            p.add_argument(x)
        options(p)
        return p

    p = verb("create", _adds(("--text_dir", {"required": True}), ("--repr_dir", {}), ("--lang", {"default": "eng"}), ("--text_format", {"default": "graphemes"}), ("--repr_format", {}), ("--encoding", {"default": "utf-8"}), ("--limit", n)))
    p.add_argument("--overwrite", action="store_true")
    p = verb("merge", _adds(("--others", {"nargs": "+", "required": True})))
    p.add_argument("--overwrite", action="store_true")
    for name, (options, _) in CHANGES.items():
        p = verb(name, options)
        p.add_argument("out_step", nargs="?")
        p.add_argument("--overwrite", action="store_true")
    for name, (options, _) in OUTPUTS.items():
        verb(name, options)
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("lectern").getOrCreate()
    at = f"{a.base_dir}/{a.corpus}/{a.step}"
    if a.verb == "create":
        steps.write_step(ingest(spark, a.text_dir, a.repr_dir, a.lang, a.text_format, a.repr_format, a.encoding, a.limit), at, a.overwrite)
    elif a.verb == "merge":
        steps.write_step(sel.merge([steps.read_step(spark, x) for x in a.others]), at, a.overwrite)
    elif a.verb in OUTPUTS:
        OUTPUTS[a.verb][1](spark, steps.read_step(spark, at), a)
    else:
        before = steps.step_counts(spark, at)
        changed = CHANGES[a.verb][1](spark, steps.read_step(spark, at), a)
        other = a.out_step and a.out_step != a.step
        after = steps.write_step(changed, f"{a.base_dir}/{a.corpus}/{a.out_step}" if other else at, a.overwrite or not other)
        print("removed {removed} rows ({removed_pct} %), kept {kept}".format(**steps.removed_between(before, after)), f"of {after['seconds']:.1f} s, {after['selected']} selected", file=sys.stderr)


if __name__ == "__main__":
    main()
