"""URL filter: rules, then host word segmentation with naive Bayes.

A unigram model (word counts over all pages' texts, split at markup and
non-letters) scores every way to cut a host label into words; Viterbi's
recursion finds the best.  The words of host and path are the tokens of a
multinomial naive Bayes classifier.  It is trained on all pages: a url one of
whose words is a seed word is an example to block, any other one to allow;
rules play no part in training.

Both models are whole, however large, and stay tables: the distinct names of
the urls are joined with all word counts by their substrings, so each name is
cut with the counts of its own; and tokens are joined with their odds.  Rows
are dealt into blocks whose names and tokens are joined once a block, so a
name that all urls share is met once per block, not once per row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from fanwrite.llm.components import stored

# Fixed values: (host, path, verdict); a rule fits its host and all subdomains.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

# Words that name a page to block.
SEEDS = frozenset(
    "ads adserver adult bet bets betting casino casinos cheap escort escorts gambling jackpot loan loans "
    "malware nude payday phishing pill pills poker porn replica sex slots spam torrent torrents track tracker tracking viagra warez xxx".split()
)

SHORT = 24  # letters of a word up to which a name is looked through by its substrings; longer ones by so many first letters
SMOOTHING = 20  # tokens
BLOCK_BITS = 11  # rows of a block, as a power of two
ROWS_OUT = 20_000  # substrings handed on at once

_WORDS = re.compile(r"[^\W\d_]+")
_PARTS = re.compile(r"[^\W_]+")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    name = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.translate(name, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def longest_rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:  # noqa: ANN001
    """Text and verdict of the longest rule that fits, null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


class Unigrams(NamedTuple):
    """Log probabilities of known words; a stretch of unknown letters, of any
    length, costs ``unknown`` once and ``letter`` for each letter."""

    words: dict[str, float]
    unknown: float
    letter: float


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """``word, n``: how often each word occurs in the pages, markup left out, lower-cased."""
    text = F.lower(F.regexp_replace(F.col(html), r"<[^>]*>|&#?\w+;", " "))
    word = F.explode(F.split(text, r"[^\p{L}]+"))
    return pages.select(word.alias("word")).where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


def base_model(counts: DataFrame, seeds: frozenset[str] = SEEDS) -> Unigrams:
    """The model without the words but the seeds: its total is that of all
    words of ``counts``.  A seed that does not occur counts once."""
    # Single letters are left to the unknown stretches, or any name would fall into letters.
    total = counts.where(F.length("word") > 1).agg(F.sum("n")).first()[0] or 0
    met = {r["word"]: r["n"] for r in counts.where(F.col("word").isin(*seeds)).collect()}
    total += sum(w not in met for w in seeds) + 1
    return Unigrams({w: math.log(met.get(w, 1) / total) for w in seeds}, math.log(1 / total), math.log(1 / 26))


def segment(label: str, model: Unigrams) -> list[str]:
    """Best cut of a label into known words and unknown stretches (Viterbi).

    Equal scores go to the cut whose last word is longer.
    """
    n = len(label)
    best = [(0.0, 0)] + [(-math.inf, 0)] * n
    longest = max(map(len, model.words), default=0)
    stretch = (-math.inf, 0)  # where the best unknown stretch up to here begins, and its score less its letters' up to here
    for end in range(1, n + 1):
        stretch = max(stretch, (best[end - 1][0] - model.letter * (end - 1), 1 - end))
        found = (stretch[0] + model.unknown + model.letter * end, stretch[1])
        for start in range(max(0, end - longest), end):
            if (cost := model.words.get(label[start:end])) is not None:
                found = max(found, (best[start][0] + cost, -start))
        best[end] = (found[0], -found[1])
    cuts, end = [], n
    while end:
        start = best[end][1]
        cuts.append(label[start:end])
        end = start
    return cuts[::-1]


def pieces(host_: str | None, path_: str | None) -> Iterator[tuple[str, str, bool]]:
    """What tokens are made of, in order: prefix, text, and whether it is a name to be cut."""
    for label in (host_ or "").split("."):
        yield from (("h:", name, True) for name in _WORDS.findall(label))
    for part in _PARTS.findall((path_ or "").lower()):
        if part.isdigit():
            yield "p:", f"#{len(part)}", False
        elif part.isalpha():
            yield from (("p:", name, True) for name in _WORDS.findall(part))
        else:
            yield "p:", part, False


def tokens_of(host_: str | None, path_: str | None, cuts: dict[str, Iterable[str]]) -> list[str]:
    """``h:`` words of the host's labels and ``p:`` words or numbers' lengths of the path."""
    return [kind + w for kind, text, name in pieces(host_, path_) for w in (cuts[text] if name else (text,))]


def names_of(rows: DataFrame) -> DataFrame:
    """``block, name``: the names to be cut in each block of rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            urls = zip(batch["block"], batch["host"], batch["path"], strict=True)
            found = {(b, text) for b, h, p in urls for _, text, name in pieces(h, p) if name}
            yield pd.DataFrame(list(found), columns=["block", "name"])

    return rows.select("block", "host", "path").mapInPandas(run, "block bigint, name string").distinct()


def substrings(names: DataFrame) -> DataFrame:
    """``id, word``: the distinct substrings of each name of up to ``SHORT`` letters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, str]] = []
        for batch in batches:
            for i, name in zip(batch["id"], batch["name"], strict=True):
                for size in range(2, min(SHORT, len(name)) + 1):
                    seen = {name[k : k + size] for k in range(len(name) - size + 1)}
                    held += ((i, w) for w in seen)
                    if len(held) >= ROWS_OUT:
                        yield pd.DataFrame(held, columns=["id", "word"])
                        held = []
        yield pd.DataFrame(held, columns=["id", "word"])

    return names.mapInPandas(run, "id bigint, word string")


def words_in(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``id, word, n``: the counted words that each name holds.

    Words of up to ``SHORT`` letters meet a name by its substrings.  A longer one meets
    the names that hold its first ``SHORT`` letters, and is then looked for whole.
    """
    parts = substrings(names)
    short = parts.join(counts.where(F.length("word") <= SHORT), "word")
    long = counts.where(F.length("word") > SHORT).select(F.substring("word", 1, SHORT).alias("first"), F.col("word").alias("whole"), "n")
    begun = parts.where(F.length("word") == SHORT).join(long, F.col("word") == F.col("first")).select("id", "whole", "n")
    held = begun.join(names, "id").where(F.contains("name", "whole")).select("id", F.col("whole").alias("word"), "n")
    return short.select("id", "word", "n").union(held)


def cut_names(names: DataFrame, counts: DataFrame, seeds: frozenset[str] = SEEDS) -> DataFrame:
    """``name, cut``: each name (once in ``names``) cut by the counts of all words."""
    model = base_model(counts, seeds)
    names = stored(names.withColumn("id", F.monotonically_increasing_id()), "url-names")
    known = words_in(names, counts).groupBy("id").agg(F.collect_list("word").alias("words"), F.collect_list("n").alias("counts"))
    top = -model.unknown  # the total's logarithm

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cuts = []
            for name, words, ns in zip(batch["name"], batch["words"], batch["counts"], strict=True):
                own = {} if words is None else {w: math.log(n) - top for w, n in zip(words, ns, strict=True)}
                cuts.append(segment(name, model._replace(words=model.words | own)))
            yield pd.DataFrame({"name": batch["name"], "cut": cuts})

    return names.join(known, "id", "left").select("name", "words", "counts").mapInPandas(run, "name string, cut array<string>")


def tokenized(rows: DataFrame, counts: DataFrame, seeds: frozenset[str] = SEEDS) -> DataFrame:
    """``rows`` (columns host, path and others) with ``block`` and ``tokens``."""
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    rows = stored(rows.withColumn("block", block), "url-rows")
    names = stored(names_of(rows), "url-block-names")
    cuts = names.join(cut_names(names.select("name").distinct(), counts, seeds), "name")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = dict(zip(right["name"].to_pylist(), right["cut"].to_pylist(), strict=True))
        urls = zip(left["host"].to_pylist(), left["path"].to_pylist(), strict=True)
        return left.append_column("tokens", pa.array([tokens_of(h, p, known) for h, p in urls], pa.list_(pa.string())))

    schema = StructType([*rows.schema.fields]).add("tokens", ArrayType(StringType()))
    return stored(rows.groupBy("block").cogroup(cuts.groupBy("block")).applyInArrow(run, schema), "url-tokens")


def seeded(tokens: Column, seeds: frozenset[str] = SEEDS) -> Column:
    """Whether one of the words is a seed: the label that the classifier learns from."""
    return F.exists(tokens, lambda t: F.substring(t, 3, 1 << 30).isin(*seeds))


def train(rows: DataFrame, seeds: frozenset[str] = SEEDS) -> tuple[float, DataFrame]:
    """Multinomial naive Bayes over all rows of ``rows`` (column tokens): the log
    odds (block over allow) of the classes, and ``token, odds`` of each token.

    Each class's token shares are smoothed with ``SMOOTHING`` tokens drawn from
    both classes together, so a token as common in one as in the other speaks
    for neither however unequal the classes are.
    """
    classed = rows.select((F.col("seeded") if "seeded" in rows.columns else seeded(F.col("tokens"), seeds)).alias("seeded"), "tokens")
    n = {r["seeded"]: (r["count"], r["size"]) for r in classed.groupBy("seeded").agg(F.count("*").alias("count"), F.sum(F.size("tokens")).alias("size")).collect()}
    (blocked, block_size), (allowed, allow_size) = n.get(True, (0, 0)), n.get(False, (0, 0))
    one = F.col("seeded").cast("bigint")
    counted = classed.select("seeded", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum(one).alias("block"), F.sum(1 - one).alias("allow"))
    both = (F.col("block") + F.col("allow")) * (SMOOTHING / max(1, block_size + allow_size))
    share = {c: (F.col(c) + both) / float(size + SMOOTHING) for c, size in (("block", block_size), ("allow", allow_size))}
    return math.log((blocked + 1) / (allowed + 1)), counted.select("token", (F.log(share["block"]) - F.log(share["allow"])).alias("odds"))


def judge(rows: DataFrame, prior: float, odds: DataFrame) -> DataFrame:
    """``rows`` with ``block_score``, the log odds of blocking, instead of ``block`` and ``tokens``."""
    own = rows.select(F.col("block").alias("of"), F.explode("tokens").alias("token")).distinct().join(odds, "token")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = dict(zip(right["token"].to_pylist(), right["odds"].to_pylist(), strict=True))
        scores = [prior + sum(known[t] for t in tokens) for tokens in left["tokens"].to_pylist()]
        return left.drop_columns(["block", "tokens"]).append_column("block_score", pa.array(scores, pa.float64()))

    schema = StructType([f for f in rows.schema.fields if f.name not in ("block", "tokens")]).add("block_score", DoubleType())
    return rows.groupBy("block").cogroup(own.groupBy("of")).applyInArrow(run, schema)


def _named(pages: DataFrame, key: str, url: str) -> DataFrame:
    named = pages.select(F.col(key).alias("_key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    return named.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})


def held_out_counts(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", seeds: frozenset[str] = SEEDS) -> DataFrame:
    """``seeded, blocked, urls``: what the classifier adds to the list of seeds.

    Seed words are taken out of all urls' tokens.  It learns from four fifths of the
    urls (crc32 of the key) and judges the others: the counts give its precision and
    recall in finding, by the words beside them, the urls that held a seed.
    """
    rows = tokenized(_named(pages, key, url), stored(word_counts(pages, html), "url-words"), seeds)
    bare = F.filter("tokens", lambda t: ~F.substring(t, 3, 1 << 30).isin(*seeds))
    out = F.crc32(F.col("_key").cast("string").cast("binary")) % 5 == 0
    rows = stored(rows.withColumns({"seeded": seeded(F.col("tokens"), seeds), "tokens": bare, "out": F.coalesce(out, F.lit(False))}), "url-folds")
    prior, odds = train(rows.where("NOT out"), seeds)
    # A token of the held-out urls alone speaks for neither class.
    every = rows.select(F.explode("tokens").alias("token")).distinct().join(odds, "token", "left").select("token", F.coalesce("odds", F.lit(0.0)).alias("odds"))
    judged = judge(rows.where("out"), prior, every)
    return judged.groupBy("seeded", (F.col("block_score") > 0).alias("blocked")).agg(F.count("*").alias("urls"))


def filter_urls(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules=RULES, seeds: frozenset[str] = SEEDS) -> DataFrame:  # noqa: ANN001
    """``key, host, path, rule, verdict, block_score`` for every row.

    The longest rule that fits decides; without one, the classifier blocks if
    the log odds are above 0.  A null url or one without ``://`` has an empty
    host and path.  Null texts count no words.  Repeated rows stay; other
    columns are not read; an empty table gives an empty result.
    """
    rows = tokenized(_named(pages, key, url), stored(word_counts(pages, html), "url-words"), seeds)
    judged = judge(rows, *train(rows, seeds))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("block_score") > 0, "block").otherwise("allow")
    return judged.select(F.col("_key").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"), "block_score")
