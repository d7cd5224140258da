"""Quality rules by distribution divergence, in Spark expressions only.

A document is compared with a reference of its language, made of all documents of that language: a histogram of
character classes and a histogram of common words (and one bin for all others). The measure is the Jensen-Shannon
distance (base 2, so between 0 and 1). The noise of a histogram of n draws falls as 1/sqrt(n), hence a limit of
base + slope/sqrt(n words), and no verdict at all below a minimum of words. Before that stand base rules that need no
reference: too few words, and too many words in windows that the text repeats.

References. Each document of MIN_WORDS words or more has the same weight, so that long ones do not decide; weights are
whole numbers, so that sums do not depend on order. Words are counted in two passes over all documents: the first sums
weights by (language, hash bucket), which any task folds to BUCKETS rows a language; words with a share of LEAST_SHARE
or more lie in the at most 1 / LEAST_SHARE buckets with such a share, and only those buckets' words are counted by
word in the second. A language with fewer than MIN_DOCS such documents has no reference.

Defined results: a null text counts as the empty one, and fails the base rules; a null language is a language of its
own; a document whose language has no reference, or with fewer than MIN_WORDS words, is judged by the base rules
alone; repeated rows get a row each (and weigh as often in the references); other columns are ignored by judge() and
kept by keep_good(); an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.llm.session import forget, store

BLANKS = " \t\n\v\f\r"
#: Base rules.
#: The width of windows is fixed by how their hashes are put together.
LEAST_WORDS, WIDTH, REPEAT_PERCENT = 10, 5, 20
#: References: words a document must have, documents a language must have, words in a histogram and their least share.
MIN_WORDS, MIN_DOCS, COMMON, LEAST_SHARE = 50, 10, 32, 0.001
BUCKETS, SCALE, PLACES = 1 << 16, 100_000_000, 1 << 6
#: Limits of the two distances: (base, slope).
CLASS_LIMIT, WORD_LIMIT = (0.15, 0.8), (0.22, 1.4)
#: Character classes of ASCII by their characters; beyond it lies one more.
CLASSES = {"capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": "0123456789", "points": ".,;:!?'\"()-", "marks": "#$%&*+/<=>@[\\]^_`{|}~"}
SYMBOLS, BEYOND = "#*$%&|<>", "[^\\x00-\\x7F]+"


def _split_words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def _once(df: DataFrame, *columns: str | Column) -> DataFrame:
    """columns of df, by a generator: Spark would write a filter's columns out again in full below it, and compute a text's
    words anew for each of them."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def _lang(lang_col: str | None) -> Column:
    return (F.coalesce(F.col(lang_col).cast("string"), F.lit("")) if lang_col else F.lit("")).alias("lang")


def _let(value: Column, f) -> Column:
    """f(value), with value computed once."""
    return F.get(F.transform(F.array(value), f), 0)


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("bigint")


def _class_counts(rare: Column, chars: Column, word_chars: Column) -> Column:
    """How many characters of each class (the last two: blanks, and all else). rare: the text without lower-case ASCII letters and blanks."""
    of = [_count(rare, c) for c in CLASSES.values()] + [(F.length(rare) - F.length(F.regexp_replace(rare, BEYOND, ""))).cast("bigint")]
    sums = lambda a: F.concat(a, F.array(chars - F.aggregate(a, F.lit(0).cast("bigint"), lambda x, y: x + y)))
    return _let(F.array(*of, chars - word_chars), sums)


def _rare(text: Column) -> Column:
    return F.regexp_replace(text, "[a-z\\x20\\x09-\\x0D]+", "")


def _sizes() -> list[Column]:
    """n, word_chars and chars of a text t with the words w."""
    return [F.size("w").cast("bigint").alias("n"), F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"), F.length("t").cast("bigint").alias("chars")]


def _bucket(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(BUCKETS - 1).cast("bigint")).cast("int")


def references(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """A row a language: lang, common (array of words), common_shares and class_shares (arrays of double); stored."""
    rows = docs.select(_lang(lang_col), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    per_class = [F.expr(f"{SCALE}L * classes[{k}] div chars") for k in range(len(CLASSES) + 3)]
    enough = F.col("n") >= MIN_WORDS
    sums = rows.select("lang", "t", _split_words(F.col("t")).alias("w")).select("lang", *_sizes(), _rare(F.col("t")).alias("rare"))
    sums = sums.select("lang", "n", "chars", _class_counts(F.col("rare"), F.col("chars"), F.col("word_chars")).alias("classes"))
    sums = sums.select("lang", enough.alias("enough"), F.when(enough, F.expr(f"n * ({SCALE}L div n)")).alias("weight"), *[F.when(enough, c).alias(f"c{k}") for k, c in enumerate(per_class)])
    sums = sums.groupBy("lang").agg(F.count_if("enough").alias("docs"), F.sum("weight").alias("all"), *[F.sum(f"c{k}").alias(f"c{k}") for k in range(len(per_class))])
    total = sum((F.col(f"c{k}") for k in range(1, len(per_class))), F.col("c0"))
    langs = store(sums.where(F.col("docs") >= MIN_DOCS).select("lang", "all", F.array(*[F.col(f"c{k}") / total for k in range(len(per_class))]).alias("class_shares")), "languages")
    words = rows.select("lang", _split_words(F.lower("t")).alias("w"))
    words = words.select("lang", F.expr(f"{SCALE}L div nullif(size(w), 0)").alias("weight"), F.explode(F.when(F.size("w") >= MIN_WORDS, F.col("w"))).alias("word"))
    bucket = _bucket(F.col("word")).alias("bucket")
    heavy = words.groupBy("lang", bucket).agg(F.sum("weight").alias("weight")).join(langs.select("lang", "all"), "lang").where(F.col("weight") >= LEAST_SHARE * F.col("all"))
    heavy = store(heavy.select("lang", "bucket"), "buckets")  # so that Spark knows its size before it joins
    found = words.withColumn("bucket", bucket).join(heavy, ["lang", "bucket"], "left_semi").groupBy("lang", "word").agg(F.sum("weight").alias("weight"))
    found = found.join(langs.select("lang", "all"), "lang").where((F.col("weight") >= LEAST_SHARE * F.col("all")) & F.col("word").rlike(r"\p{L}"))
    top = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("weight"), "word"))).where(F.col("rank") <= COMMON)
    common = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("rank", "word", (F.col("weight") / F.col("all")).alias("share")))).alias("top"))
    out = langs.join(common, "lang", "left").select("lang", "class_shares", F.coalesce(F.col("top.word"), F.array().cast("array<string>")).alias("common"), F.coalesce(F.col("top.share"), F.array().cast("array<double>")).alias("common_shares"))
    out = store(out, "references")
    forget(langs, heavy)
    return out


def _distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    half = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: half(a, b) + half(b, a))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def _rest(shares: Column) -> Column:
    """shares, and what they lack of 1."""
    return F.concat(shares, F.array(F.greatest(F.lit(0.0), 1 - F.aggregate(shares, F.lit(0.0), lambda a, x: a + x))))


def _buckets(words: str) -> Column:
    """words in PLACES arrays by their hash, so that a word is looked up among few."""
    place = F.transform(words, lambda x: F.struct(_place(x).alias("p"), x.alias("x")))
    return F.transform(F.sequence(F.lit(0), F.lit(PLACES - 1)), lambda b: F.transform(F.filter(place, lambda s: s["p"] == b), lambda s: s["x"]))


def _place(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(PLACES - 1).cast("bigint")).cast("int")


def _windows() -> Column:
    """A hash of each run of WIDTH (five) words of a text that may repeat one, else nothing.

    zip_with walks two arrays once; slices of words at each place would copy the array each time. Most texts repeat not
    even the first two and last two words of a window, which two walks tell; only the others' windows are hashed whole:
    two words, two such pairs, and that with the fifth."""
    pairs = lambda a, b: F.zip_with(a, b, lambda x, y: F.xxhash64(x, y))
    from_ = lambda a, k: F.slice(a, F.lit(k + 1), F.greatest(F.size(a) - k, F.lit(0)))
    upto = lambda a, k: F.slice(a, F.lit(1), F.greatest(F.size(a) - k, F.lit(0)))
    w = F.col("w")
    whole = lambda p: _let(pairs(upto(p, 2), from_(p, 2)), lambda q: pairs(upto(q, 1), from_(w, 4)))
    none = F.array().cast("array<bigint>")
    may = lambda p: _let(pairs(upto(p, 3), from_(p, 3)), lambda e: F.size(F.array_distinct(e)) < F.size(e))
    return _let(pairs(upto(w, 1), from_(w, 1)), lambda p: F.when(may(p), whole(p)).otherwise(none))


def _repeated() -> Column:
    """Where the windows begin that occur twice or more, as (hash, place) in the order of both."""
    at = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    return F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(at)).otherwise(F.array().cast("array<struct<h:bigint,at:int>>"))


def _covered() -> Column:
    """Words in those windows: each adds WIDTH, or as many as lie before the next."""
    s = F.col("in_order")
    twice = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]))
    gaps = lambda q: F.transform(q, lambda x, i: F.least(F.lit(WIDTH), F.coalesce(F.get(q, i + 1) - x, F.lit(WIDTH))).cast("bigint"))
    return F.aggregate(_let(F.sort_array(F.transform(twice, lambda x: x["at"])), gaps), F.lit(0).cast("bigint"), lambda a, x: a + x)


def _judged(docs: DataFrame, row: Column, text_col: str, lang_col: str | None, reference: DataFrame | None) -> DataFrame:
    """Steps of which each drops what the next does not read, as every step writes its columns anew."""
    reference = references(docs, text_col, lang_col) if reference is None else reference
    reference = store(reference.withColumn("places", _buckets("common")).withColumn("longest", F.array_max(F.transform("common", F.octet_length))), "places")
    n = F.col("n").cast("double")
    rows = docs.select(row.alias("row"), _lang(lang_col), F.coalesce(F.col(text_col), F.lit("")).alias("t"), _split_words(F.coalesce(F.col(text_col), F.lit(""))).alias("w"))
    own = ["row", "n", "word_chars", "chars", "common", "common_shares", "class_shares"]
    lines = F.filter(F.split("t", "\n"), lambda x: F.octet_length(F.ltrim(x, F.lit(BLANKS))) > 0)
    hits = F.filter(_split_words(F.lower("t")), lambda x: (F.octet_length(x) <= F.col("longest")) & F.array_contains(F.get("places", _place(x)), x))
    judged = F.col("class_shares").isNotNull() & (F.size("w") >= MIN_WORDS)
    out = rows.join(reference, "lang", "left").select(
        "row", *_sizes(), "common", "common_shares", "class_shares", judged.alias("judged"), _rare(F.col("t")).alias("rare"), _windows().alias("windows"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"), F.when(judged, F.concat(F.lit(" "), F.array_join(hits, "  "), F.lit(" "))).alias("hits"),  # each word between blanks of its own
    )
    shares = F.transform("common", lambda x: ((F.octet_length("hits") - F.octet_length(F.replace(F.col("hits"), F.concat(F.lit(" "), x, F.lit(" ")), F.lit("")))) / (F.octet_length(x) + 2)).cast("bigint") / n)
    out = out.select(
        *own, "judged", "n_dup_lines", _repeated().alias("in_order"), F.when(F.col("judged"), shares).alias("shares"), _class_counts(F.col("rare"), F.col("chars"), F.col("word_chars")).alias("classes"),
        _count(F.col("rare"), SYMBOLS).alias("n_symbols"),
    )
    by_word, by_class = _distance(_rest(F.col("shares")), _rest(F.col("common_shares"))), _distance(F.transform("classes", lambda c: c / F.col("chars")), F.col("class_shares"))
    out = out.select("row", "n", "word_chars", "n_symbols", "n_dup_lines", _covered().alias("n_repeat_words"), F.when(F.col("judged"), by_word).alias("word_distance"), F.when(F.col("judged"), by_class).alias("class_distance"))
    failed = (F.col("n") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n"))
    far = (F.col("word_distance") > WORD_LIMIT[0] + WORD_LIMIT[1] / F.sqrt(n)) | (F.col("class_distance") > CLASS_LIMIT[0] + CLASS_LIMIT[1] / F.sqrt(n))
    return out.select("*", failed.alias("base_failed")).select("*", (~F.col("base_failed") & ~F.coalesce(far, F.lit(False))).alias("kept"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", reference: DataFrame | None = None) -> DataFrame:
    """id, the base counts and verdict, kept, and the two distances (null where they are not judged). reference: of references(), made of docs if left out."""
    out = _judged(docs, F.col(id_col), text_col, lang_col, reference)
    return _once(out, F.col("row").alias(id_col), F.col("n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", reference: DataFrame | None = None) -> DataFrame:
    """The rows of docs that are kept, with all their columns."""
    return _judged(docs, F.struct("*"), text_col, lang_col, reference).select(F.inline(F.when(F.col("kept"), F.array("row"))))
