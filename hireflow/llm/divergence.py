"""Quality by divergence: a document's histograms against references of its language.

Two histograms per document: characters by class, and words by the most common words of the
language with one bin for all others. References are the same histograms over all documents of a
language. A document is rejected if the Jensen-Shannon distance of either exceeds its limit, or if
it fails the base rules. Distances of short texts are mostly chance, so a limit is raised by a
share that falls with the square root of the length, and documents below ``GUARD_WORDS`` words (or
``GUARD_CHARS`` characters) are not compared at all.

Word references take one aggregation over all words, which combines in the reading tasks; a second
pass gives each document's figures, whose sums are the character references. A language with
at least ``SHARE`` of all words has references of its own: every language that has words, so
that a verdict does not turn on what other languages are in the table. A rare language is compared to
what little there is of it. Only documents of null language share the references of all
documents. References are broadcast while they are small and joined by a shuffle beyond that.
Nothing else is shuffled: all figures of a document are array functions in its row.

* Null and empty texts have no words and fail the base rules.
* Repeated rows are judged one by one; ties between equally common words go by the alphabet.
* Extra columns are kept by ``keep`` only; an empty table gives no rows.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from hireflow.llm.shared import bounded, let, spaced_words, whole_text, written

#: Base rules: fewest words, and most words in repeated windows, in percent.
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Words in a window that counts as repeated when it occurs twice.
REPEAT_WINDOW = 3

#: Common words in a reference.
COMMON = 24

#: Share of all words from which a language has references of its own.
SHARE = 0.0

#: Bytes of a language's references in a broadcast, at most.
REFERENCE_BYTES = 4096

#: Limits of the two distances for long texts, and what is added at one word or character.
#: A document with none of the common words is at a word distance of about 0.35, so it is told from
#: 240 to 280 words on. The spread of labelled good documents would allow 0.10 and 2.2, but not where
#: copies of one text make up a third of a language and shift its reference.
CHAR_LIMIT, CHAR_SLACK = 0.25, 1.0
WORD_LIMIT, WORD_SLACK = 0.22, 2.0

#: Shorter texts are not compared.
GUARD_WORDS, GUARD_CHARS = 60, 200

#: Character classes, each counted in what the classes before it leave; the rest is the last bin.
CLASSES = ("\\p{Ll}+", "[\\x20\\x09-\\x0D]+", "\\p{Lu}+", "\\p{Nd}+", "[.,;:!?'\"()-]+")

#: Place of the separators of words among the classes.
SPACE_CLASS = 1

#: Lower bits of a number that hold the place of a window; the rest are of its hash.
PLACE_BITS = 20

#: Name of the references of all documents.
ALL = "*"


def class_counts(text: Column) -> Column:
    """Characters of each class, and all others."""

    def step(rest: Column, classes: tuple[str, ...]) -> Column:
        if not classes:
            return F.array(F.char_length(rest))
        return let(
            F.regexp_replace(rest, classes[0], ""),
            lambda less: F.concat(
                F.array(F.char_length(rest) - F.char_length(less)), step(less, classes[1:])
            ),
        )

    return step(text, CLASSES)


def repeated_words(words: Column) -> Column:
    """Words in windows that occur twice or more in the text, the first included.

    Windows are sorted as numbers made of the upper bits of a hash and the place; neighbours
    with equal bits are repeats. If two of them turn out to be different windows, or the text has
    too many places for the lower bits, whole hashes are sorted instead.
    """
    n = REPEAT_WINDOW

    def window(w: Column, i: Column) -> list[Column]:
        return [F.get(w, i + j) for j in range(n)]

    def places(w: Column) -> Column:
        return F.sequence(F.lit(0), F.greatest(F.size(w) - n, F.lit(0)))

    def covered(at: Column) -> Column:
        return let(
            F.array_sort(at),
            lambda sorted_at: F.aggregate(
                sorted_at,
                F.struct(F.lit(0).alias("words"), F.lit(0).alias("upto")),
                lambda have, a: F.struct(
                    (have.words + F.least(F.lit(n), F.greatest(a + n - have.upto, F.lit(0)))).alias(
                        "words"
                    ),
                    F.greatest(a + n, have.upto).alias("upto"),
                ),
                lambda have: have.words,
            ),
        )

    def next_to_equal(sorted_: Column, same: Callable[[Column, Column], Column]) -> Column:
        """Places in the sorted array whose entry is like the one before."""
        return F.filter(
            F.sequence(F.lit(1), F.greatest(F.size(sorted_) - 1, F.lit(1))),
            lambda j: F.coalesce(same(F.get(sorted_, j - 1), F.get(sorted_, j)), F.lit(False)),
        )

    def quick(w: Column) -> Column:
        packed = F.transform(
            places(w),
            lambda i: F.shiftleft(F.shiftright(F.xxhash64(*window(w, i)), PLACE_BITS), PLACE_BITS)
            .bitwiseOR(i.cast("long")),
        )
        place = lambda x: x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
        upper = lambda x: F.shiftright(x, PLACE_BITS)

        def found(s: Column) -> Column:
            pairs = F.transform(
                next_to_equal(s, lambda x, y: upper(x) == upper(y)),
                lambda j: F.struct(place(F.get(s, j - 1)).alias("a"), place(F.get(s, j)).alias("b")),
            )
            return let(
                pairs,
                lambda p: F.when(
                    F.exists(
                        p, lambda x: F.array(*window(w, x.a)) != F.array(*window(w, x.b))
                    ),
                    slow(w),
                ).otherwise(
                    covered(
                        F.concat(F.transform(p, lambda x: x.a), F.transform(p, lambda x: x.b))
                    )
                ),
            )

        return let(F.sort_array(packed), found)

    def slow(w: Column) -> Column:
        hashes = F.transform(
            places(w), lambda i: F.struct(F.xxhash64(*window(w, i)).alias("hash"), i.alias("at"))
        )
        return let(
            F.sort_array(hashes),
            lambda s: let(
                next_to_equal(s, lambda x, y: x.hash == y.hash),
                lambda js: covered(
                    F.concat(
                        F.transform(js, lambda j: F.get(s, j - 1)["at"]),
                        F.transform(js, lambda j: F.get(s, j)["at"]),
                    )
                ),
            ),
        )

    return let(
        words,
        lambda w: F.when(F.size(w) < n, F.lit(0))
        .when(F.size(w) < 1 << PLACE_BITS, quick(w))
        .otherwise(slow(w))
        .cast("long"),
    )


def figures(docs: DataFrame, common: DataFrame, keep: list[str], text: str, lang: str) -> DataFrame:
    """``keep``, the base figures and both histograms of every document, in one pass.

    ``common``: the common words of each language and of ``ALL``.
    """
    whole = whole_text(text)
    names = [f"keep_{i}" for i in range(len(keep))]
    read = docs.select(
        *[F.col(c).alias(n) for c, n in zip(keep, names)],
        F.col(lang).alias("own_lang"),
        whole.alias("whole"),
        spaced_words(whole).alias("words"),
        class_counts(whole).alias("class_bins"),
    )
    own = common.select(F.col("lang").alias("own_lang"), F.col("common").alias("own"))
    pooled = common.where(F.col("lang") == ALL).select(
        F.col("lang").alias("all_lang"), F.col("common").alias("pooled")
    )
    lines = F.filter(F.split("whole", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    n_words = F.size("words").cast("long")
    # a document without words has an empty histogram, also where there are no references
    bins = common_counts(F.col("words"), F.coalesce("own", "pooled"))
    return (
        read.join(bounded(own, REFERENCE_BYTES), "own_lang", "left")
        .join(F.broadcast(pooled), F.lit(ALL) == F.col("all_lang"), "left")
        .select(
            *names,
            F.when(F.col("own").isNotNull(), F.col("own_lang")).otherwise(F.lit(ALL)).alias("lang_"),
            F.col("own_lang").alias("doc_lang_"),
            n_words.alias("n_words"),
            F.char_length("whole").cast("long").alias("n_chars"),
            (F.char_length("whole") - F.get("class_bins", F.lit(SPACE_CLASS)))
            .cast("long")
            .alias("word_chars"),
            F.regexp_count("whole", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(
                lines.cast("array<string>"), lambda x: F.size(x) - F.size(F.array_distinct(x))
            ).cast("long").alias("n_dup_lines"),
            repeated_words(F.col("words")).alias("n_repeat_words"),
            F.transform("class_bins", lambda n: n.cast("double")).alias("class_bins"),
            let(bins, lambda b: with_rest(b, n_words)).alias("word_bins"),
        )
    )


def word_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Per language its common words and the word histogram; ``ALL`` has those of all documents."""
    each = (
        docs.select(F.col(lang).alias("lang"), F.explode(spaced_words(whole_text(text))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n"))
    )
    each = written(each, "reference-words")
    shares = each.groupBy("lang").agg(F.sum("n").alias("n"))
    large = (
        shares.withColumn("all", F.sum("n").over(Window.partitionBy()))
        .where((F.col("n") >= SHARE * F.col("all")) & (F.col("lang") != ALL))
        .select("lang")
    )
    everything = each.groupBy(F.lit(ALL).alias("lang"), "word").agg(F.sum("n").alias("n"))
    own = each.join(bounded(large, REFERENCE_BYTES), "lang", "left_semi").select(*everything.columns)
    both = own.unionByName(everything)
    by_rank = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    common = (
        both.withColumn("rank", F.row_number().over(by_rank))
        .where(F.col("rank") <= COMMON)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("common"))
    )
    totals = both.groupBy("lang").agg(F.sum("n").alias("n_words"))
    return totals.join(common, "lang").select(
        "lang",
        F.transform("common", lambda x: x.word).alias("common"),
        with_rest(F.transform("common", lambda x: x.n), F.col("n_words")).alias("word_ref"),
    )


def class_references(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Per language of ``known`` the sums of its documents' character classes."""
    sums = [
        F.sum(F.get("class_bins", F.lit(i))).alias(f"bin_{i}") for i in range(len(CLASSES) + 1)
    ]
    each = rows.groupBy(F.col("doc_lang_").alias("lang")).agg(*sums)
    whole = each.groupBy(F.lit(ALL).alias("lang")).agg(
        *[F.sum(f"bin_{i}").alias(f"bin_{i}") for i in range(len(CLASSES) + 1)]
    )
    both = each.where(F.col("lang") != ALL).unionByName(whole)
    return known.join(both, "lang").select(
        "lang", "word_ref", F.array(*[f"bin_{i}" for i in range(len(CLASSES) + 1)]).alias("class_ref")
    )


def with_rest(counts: Column, total: Column) -> Column:
    """The counts and what is missing to the total, as doubles."""
    sum_of = F.aggregate(counts, F.lit(0).cast("long"), lambda a, n: a + n)
    return F.transform(F.concat(counts, F.array(total - sum_of)), lambda n: n.cast("double"))


def common_counts(words: Column, common: Column) -> Column:
    """How often each of the common words occurs.

    In one line of all words each has a blank before it and a line feed after it, which no word
    holds, so a word is found as a whole and neighbours do not share a sign.
    """
    return let(
        F.concat(F.lit(" "), F.array_join(words, "\n "), F.lit("\n")),
        lambda line: F.transform(
            common,
            lambda w: (
                (
                    F.octet_length(line)
                    - F.octet_length(
                        F.replace(line, F.concat(F.lit(" "), w, F.lit("\n")), F.lit(""))
                    )
                )
                / (F.octet_length(w) + 2)
            ).cast("long"),
        ),
    )


def distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance (base two) of two histograms; null if one is empty."""

    def shares(bins: Column) -> Column:
        return let(
            F.aggregate(bins, F.lit(0.0), lambda x, y: x + y),
            lambda total: F.transform(bins, lambda n: F.try_divide(n, total)),
        )

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(0.0)

    parts = F.zip_with(shares(a), shares(b), lambda p, q: part(p, q) + part(q, p))
    total = F.aggregate(parts, F.lit(0.0), lambda x, y: x + y)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def judged(
    docs: DataFrame, keep: list[str], text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``keep``, the base figures, both distances, base_failed and kept of every document."""
    known = written(word_references(docs, text, lang), "references")
    rows = written(figures(docs, known.select("lang", "common"), keep, text, lang), "figures")
    references = class_references(rows, known).withColumnRenamed("lang", "lang_")
    n_words, n_chars = F.col("n_words"), F.col("n_chars")
    compared = (n_words >= GUARD_WORDS) & (n_chars >= GUARD_CHARS)
    rows = rows.join(bounded(references, REFERENCE_BYTES, known.count()), "lang_", "left").select(
        *[c for c in rows.columns if not c.endswith(("_bins", "_"))],
        ((n_words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n_words)).alias(
            "base_failed"
        ),
        F.when(compared, distance(F.col("class_bins"), F.col("class_ref"))).alias("char_distance"),
        F.when(compared, distance(F.col("word_bins"), F.col("word_ref"))).alias("word_distance"),
    )
    far = (F.col("char_distance") > CHAR_LIMIT + CHAR_SLACK / F.sqrt("n_chars")) | (
        F.col("word_distance") > WORD_LIMIT + WORD_SLACK / F.sqrt("n_words")
    )
    names = [f"keep_{i}" for i in range(len(keep))]
    return rows.select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)],
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"),
        "char_distance",
        "word_distance",
    )
