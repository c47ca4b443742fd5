"""Document fingerprints by consistent weighted sampling.

A text is a bag of lower-cased words with their counts as weights.  For each of
``SAMPLES`` draws a word has, by hash, two gamma(2, 1) values r and c and a uniform
b; with weight w it takes the level t = floor(ln w / r + b) and the rank
c / exp(r (t - b) + r).  The word of least rank, together with its level, is the
draw's sample.  Two texts agree in a draw with probability sum of min weights over
sum of max weights, the generalised Jaccard similarity, so the share of equal
samples estimates it.  A term that a text and its edited text have equally often is
drawn once for both.

All of it is one row-wise and one grouped expression; terms of a document never
leave its task, because the rows are already partitioned by document.

The least of a text's ranks is nearly always far below most of them: exp(rank) of n
words together is an exponential variable of mean 1 / n, so it is above ``REACH`` / n
once in e ** ``REACH`` draws.  Ranks that a bound without logarithms puts above that
are not worked out; a document in which a draw has nothing below it is drawn again
in full, so the samples are those of all ranks.

Defined results: null text is empty; a text without words has all samples 0, so two
such texts are alike; equal texts have equal fingerprints; rows that repeat a
doc_id each keep their own text (the next document of such an id is that with the
smallest opening); a row without doc_id is in no order: its edited text is its own
and ``near_next`` is null; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltframe.llm.common import WORD_PATTERN, broadcast_if_small, staged, text_of

#: The standard error of a likeness s is sqrt(s (1 - s) / SAMPLES): 0.044 at 0.5 and 0.035 at 0.8.
SAMPLES = 128
#: Samples that one row draws; the results do not depend on it.
BLOCK = 8
#: Ranks up to the logarithm of REACH / words are worked out, for texts of at least LEAST_WORDS; others wholly.
REACH = 20.0
LEAST_WORDS = 32
#: The logarithm of a rank lies within +-128 (c above 2 ** -48, r below 47, weights below 2 ** 40), kept in steps of 2 ** -23.
_RANK = "cast(floor(({x} + 128D) * 8388608D) as bigint)"


def _codes(text: Column, version: int) -> Column:
    """The words' hashes; their lowest bit is the version."""
    hashed = (lambda w: F.xxhash64(w).bitwiseOR(F.lit(1))) if version else (
        lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)))
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0)), hashed)


def weighted_terms(df: DataFrame, name: str, text: str, edited: str | None = None) -> DataFrame:
    """Adds ``name``: an array of (term hash, count, versions) of the words of ``text`` and of ``edited``.

    A term that both have equally often comes once, with versions 3; else versions is
    1 for ``text`` and 2 for ``edited``, or 0 for a row that says nothing more.

    ``<name>_words`` is the number of words of the version that has fewer.

    Hashes are sorted; the last place of each run gives its length.  Each step is a
    column of its own so that no step is evaluated again for every element.
    """
    hashes, ends, runs = f"_{name}_hashes", f"_{name}_ends", f"_{name}_runs"
    sides = [f"_{name}_{k}" for k in range(2 if edited else 1)]
    df = df.withColumns({side: _codes(F.col(c), k) for k, (side, c) in enumerate(zip(sides, (text, edited)))})
    sizes = [F.size(side).cast("bigint") for side in sides]
    df = df.withColumns({hashes: F.sort_array(F.concat(*sides)),
                         f"{name}_words": F.least(*sizes) if edited else sizes[0]}).drop(*sides)
    at = lambda i: F.get(F.col(hashes), i)
    df = df.withColumn(ends, F.filter(
        F.sequence(F.lit(0), F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda i: F.coalesce(at(i) != at(i + 1), at(i).isNotNull())))
    df = df.withColumn(runs, F.transform(ends, lambda p, k: F.struct(
        at(p).alias("code"), (p - F.coalesce(F.get(F.col(ends), k - 1), F.lit(-1))).alias("weight"))))

    def as_often(run: Column, k: Column, step: int) -> Column:
        other = F.get(F.col(runs), k + step)
        return F.coalesce((other["code"] == run["code"] + step) & (other["weight"] == run["weight"]), F.lit(False))

    def versions(run: Column, k: Column) -> Column:
        if not edited:
            return F.lit(1)
        return F.when(run["code"].bitwiseAND(F.lit(1)) == 0, F.when(as_often(run, k, 1), 3).otherwise(1)).otherwise(
            F.when(as_often(run, k, -1), 0).otherwise(2))

    return df.withColumn(name, F.transform(runs, lambda run, k: F.struct(
        run["code"].bitwiseAND(F.lit(-2)).alias("term"), run["weight"].alias("weight"),
        versions(run, k).alias("versions")))).drop(hashes, ends, runs)


def _drawn(rows: DataFrame, width: int, cut: bool) -> tuple[DataFrame, list[Column]]:
    """Rank and identity of ``term`` at ``log_weight`` in each draw of ``block`` as one number, smaller for a smaller rank.

    With ``cut``, null for most terms whose rank is above the logarithm of ``reach``, told without
    a logarithm: c is at least 2 (1 - q) / (1 + q) for the product q of its uniform numbers, and at
    weight 1 the other factor is p ** (1 - b), at least p / (1 - b + b p) for the product p of those
    of r; at any weight w it is p / w or more.  ``reach_weight`` is reach times w, ``single`` 1 at weight 1.

    Hashes and uniform numbers are columns of their own, so that they are made once.
    """
    bits = lambda h, n, low: f"((shiftrightunsigned({h}, {low}) & {(1 << n) - 1}L) + 0.5D)"
    draws = range(width)
    rows = rows.select("*", *[F.expr(f"xxhash64(block * {BLOCK} + {k}, term) as one{k}") for k in draws])
    rows = rows.select("*", *[F.expr(f"xxhash64(one{k}) as two{k}") for k in draws])
    # Two uniform numbers inside (0, 1) give a gamma(2, 1) value: the logarithm of their product.
    rows = rows.select("*", *[F.expr(x) for k in draws for x in (
        f"{bits(f'one{k}', 32, 0)} * {bits(f'one{k}', 32, 32)} * {2.0 ** -64}D as p{k}",
        f"{bits(f'two{k}', 24, 0)} * {bits(f'two{k}', 24, 24)} * {2.0 ** -48}D as q{k}",
        f"{bits(f'two{k}', 16, 48)} * {2.0 ** -16}D as b{k}")])

    def sample(k: int) -> Column:
        r, c = f"(-ln(p{k}))", f"(-ln(q{k}))"
        t = f"floor(log_weight / {r} + b{k})"
        rank = _RANK.format(x=f"(ln({c}) - {r} * ({t} - b{k} + 1D))")
        whole = f"shiftleft({rank}, 32) | ((one{k} ^ {t}) & 4294967295L)"
        least = f"2D * (1D - q{k}) * p{k} <= reach_weight * (1D + q{k}) * (1D - single * b{k} * (1D - p{k}))"
        return F.expr(f"if({least}, {whole}, null)" if cut else whole)

    return rows, [sample(k) for k in draws]


def signatures(df: DataFrame, keys: list[str], terms: str, samples: int = SAMPLES, also: tuple[str, ...] = (),
               cut: bool = False) -> DataFrame:
    """``keys``, ``own`` and ``edit``: arrays of ``samples`` numbers for both versions of each key's weighted terms.

    A row draws ``BLOCK`` samples, which keeps the generated code small; a term that both
    versions have equally often is drawn once for both.  ``also`` are numbers that depend on
    the keys; they go along as terms of versions of their own (4, 5, ...), because each more
    column of a draw's row costs more than the few rows.  With ``cut``, ``short`` tells keys with a draw that has no rank within reach:
    their samples may be wrong.
    """
    blocks = range(-(-samples // BLOCK))
    width = min(BLOCK, samples)
    also = (*also, f"{terms}_words") if cut else also
    words = F.col(f"{terms}_words")
    numbers = [F.struct(F.col(c).cast("bigint").alias("term"), F.lit(1).alias("weight"), F.lit(4 + k).alias("versions"))
               for k, c in enumerate(also)]
    items = F.concat(F.col(terms), F.array(*numbers)) if also else F.col(terms)
    rows = df.select(*keys, *([words] if cut else []), F.explode_outer(items).alias("_t"))
    rows = rows.where("_t is null or _t.versions > 0").select(
        *keys, F.col("_t.versions").alias("versions"), F.col("_t.term").alias("term"),
        F.ln(F.col("_t.weight").cast("double")).alias("log_weight"),
        *([F.when(words >= LEAST_WORDS, F.col("_t.weight") * (F.lit(REACH) / words)).otherwise(
            float("inf")).alias("reach_weight"),
           F.when(F.col("_t.weight") == 1, 1.0).otherwise(0.0).alias("single")] if cut else []))
    rows = rows.withColumn("block", F.explode(F.array(*map(F.lit, blocks))))
    rows, drawn = _drawn(rows, width, cut)
    if also:
        drawn[0] = F.when(F.col("versions") > 3, F.col("term")).otherwise(drawn[0])
    drawn = rows.groupBy(*keys, "block", "versions").agg(*[F.min(x).alias(f"s{k}") for k, x in enumerate(drawn)])
    drawn = drawn.select(*keys, "block", "versions", F.array(*[f"s{k}" for k in range(width)]).alias("drawn"))
    by_key = drawn.groupBy(*keys).agg(*[
        F.max(F.when((F.col("block") == b) & (F.col("versions") == v), F.col("drawn"))).alias(f"d{b}_{v}")
        for b in blocks for v in (1, 2, 3)],
        *[F.max(F.when((F.col("block") == 0) & (F.col("versions") == 4 + k), F.get("drawn", F.lit(0)))).alias(c)
          for k, c in enumerate(also)])
    # The low 32 bits, as a signed number.
    low = lambda x: F.shiftright(F.shiftleft(x, 32), 32).cast("int")

    def of(version: int) -> Column:
        whole = [F.coalesce(
            F.zip_with(F.coalesce(f"d{b}_{version}", f"d{b}_3"), F.coalesce(f"d{b}_3", f"d{b}_{version}"),
                       lambda x, y: F.least(x, y)),
            F.array_repeat(F.lit(0).cast("bigint"), width)) for b in blocks]
        return F.slice(F.concat(*whole), 1, samples)

    by_key = by_key.select(*keys, *also, of(1).alias("own"), of(2).alias("edit"))
    out = [*keys, *[c for c in also if c != f"{terms}_words"],
           F.transform("own", low).alias("own"), F.transform("edit", low).alias("edit")]
    if cut:
        # One step below the place of REACH / words, because ranks are rounded to steps.
        last = F.shiftleft(F.floor((F.lit(math.log(REACH)) - F.ln(words) + 128.0) * 8388608.0) - 1, 32)
        lacks = lambda x: x.isNull() | (x >= last)
        out.append(((words >= LEAST_WORDS) & (F.exists("own", lacks) | F.exists("edit", lacks))).alias("short"))
    return by_key.select(*out)


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples: the estimate of the generalised Jaccard similarity."""
    same = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(same, F.lit(0), lambda s, x: s + x) / F.lit(float(samples))


def as_text(signature: Column) -> Column:
    """Eight hexadecimal digits a sample."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(
        F.hex(x.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def followers(ids: DataFrame) -> DataFrame:
    """doc_id and next_id, the next larger one (after the largest: the smallest), of distinct ids.

    Ids are sorted over all tasks; inside a task's range the next row gives the
    follower, and one row a task links the ranges.
    """
    ordered = staged(ids.orderBy("doc_id").withColumn("place", F.monotonically_increasing_id()), "order")
    ordered = ordered.withColumn("range", F.shiftright("place", 33))
    inside = ordered.withColumn("next_id", F.lead("doc_id").over(Window.partitionBy("range").orderBy("place")))
    starts = ordered.groupBy("range").agg(F.min("doc_id").alias("start"))  # one row a range from here on
    by_range = Window.orderBy("range")
    links = starts.select("range", F.coalesce(
        F.lead("start").over(by_range),
        F.min("start").over(Window.partitionBy(F.lit(1)))).alias("next_start"))
    return inside.join(staged(links, "order-links"), "range").select(
        "doc_id", F.coalesce("next_id", "next_start").alias("next_id"))


def with_edited(docs: DataFrame) -> DataFrame:
    """doc_id, next_id, text and edited: the last quarter replaced by the next document's opening.

    Rows without doc_id are left out.  The rows stay partitioned by doc_id.
    """
    placed = _rows(docs).where("doc_id is not null")
    quarter = F.floor(F.length("text") / 4).cast("int")
    # Identifiers and lengths only: the longest opening that rows of this id ask of the next document.
    asked = staged(placed.groupBy("doc_id").agg(F.max(quarter).alias("asked")), "asked")
    needs = asked.join(followers(asked.select("doc_id")), "doc_id")
    needs = staged(needs, "needs")
    # Both joins shuffle the texts by doc_id in the same way, so that shuffle is made once.
    openings = (placed.join(needs.select(F.col("next_id").alias("doc_id"), F.col("doc_id").alias("before_id"),
                                         "asked"), "doc_id")
                .select("before_id", "doc_id", F.expr("substring(text, 1, asked)").alias("opening"))
                .groupBy("before_id", "doc_id").agg(F.min("opening").alias("opening"))
                .select(F.col("before_id").alias("doc_id"), F.col("doc_id").alias("next_id"), "opening"))
    return placed.join(openings, "doc_id", "left").select(
        "doc_id", "next_id", "text",
        F.expr("concat(substring(text, 1, length(text) - floor(length(text) / 4)), "
               "substring(coalesce(opening, ''), 1, floor(length(text) / 4)))").alias("edited"))


def _rows(docs: DataFrame) -> DataFrame:
    # A bigint doc_id stays the column it is: an alias would make the two shuffles of with_edited() differ.
    own = F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("bigint").alias("doc_id")
    return docs.select(own, text_of("text").alias("text"))


def fingerprint(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id and the signature of each row's text."""
    rows = _rows(docs)
    rows = weighted_terms(rows.withColumn("text_sha256", F.sha2("text", 256)), "terms", "text")
    return signatures(rows, ["doc_id", "text_sha256"], "terms", samples).select(
        "doc_id", "text_sha256", F.col("own").alias("signature"))


#: Few and short, because every draw is grouped by them: a row's edited text follows from its doc_id and text.
_KEYS = ["doc_id", "text_key"]
#: The digest of the edited text as numbers of 13 hexadecimal digits (the last: 12).
_DIGEST = {f"digest{k}": (13 * k + 1, min(13, 64 - 13 * k)) for k in range(5)}


def _terms(rows: DataFrame) -> DataFrame:
    """``_KEYS``, numbers that follow from them and the weighted terms of text and edited of each row."""
    rows = rows.withColumns({
        "n_chars": F.length("text").cast("bigint"), "text_key": F.xxhash64("text"), "_digest": F.sha2("edited", 256)})
    rows = rows.withColumns({name: F.conv(F.substring("_digest", at, n), 16, 10).cast("bigint")
                             for name, (at, n) in _DIGEST.items()})
    return weighted_terms(rows, "terms", "text", "edited").select(
        *_KEYS, "next_id", "n_chars", *_DIGEST, "terms", "terms_words")


def _signed(rows: DataFrame, samples: int, cut: bool = False) -> DataFrame:
    """The signatures of text and edited of each row; partitioned by doc_id, the rows are not shuffled."""
    return signatures(_terms(rows), _KEYS, "terms", samples, ("next_id", "n_chars", *_DIGEST), cut)


def _pairs(docs: DataFrame, samples: int) -> DataFrame:
    """The signatures of all rows, those of short ones drawn again from all ranks."""
    alone = _rows(docs).where("doc_id is null").select(
        "doc_id", F.lit(None).cast("bigint").alias("next_id"), "text", F.col("text").alias("edited"))
    parts = [with_edited(docs), alone]
    first, second = [_signed(p, samples, True) for p in parts]
    pairs = staged(first.unionAll(second), "signatures")
    ids = pairs.where("short").select(F.col("doc_id").alias("short_id")).distinct()
    if not ids.limit(1).count():
        return pairs.drop("short")
    ids = broadcast_if_small(staged(ids, "short"))
    same = F.col("doc_id").eqNullSafe(F.col("short_id"))
    first, second = [_signed(p.join(ids, same, "left_semi"), samples) for p in parts]
    again = staged(first.unionAll(second), "signatures")
    return pairs.drop("short").join(ids, same, "left_anti").unionAll(again)


def compare_with_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness to each other and to the next."""
    pairs = _pairs(docs, samples)
    following = pairs.groupBy(F.col("doc_id").alias("next_id")).agg(F.min("own").alias("next_own"))
    joined = pairs.join(following, "next_id", "left")
    digest = F.concat(*[F.lpad(F.lower(F.hex(name)), n, "0") for name, (_, n) in _DIGEST.items()])
    return joined.select(
        "doc_id", "n_chars", digest.alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("edit")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edit"), samples).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own"), samples).alias("near_next"))
