"""Quality rules: measures of a text, and lines that very many documents of a host share.

All of it is DataFrame functions. The measures of a document are written once, with a hash of each of
its lines and the host; the lines alone are then counted, and only lines above the limit come back.
"""

from pyspark.sql import functions as F

from edgeflow.plans import keep

#: White space between words, as a class of a pattern.
SPACE = r"[\x20\x09-\x0D]"
_SPACES = " \t\n\x0b\f\r"
# fixed value: the characters that count as symbols
SYMBOLS = "#*$%&|<>"
#: Words of a repeated window.
RUN = 5
#: A line goes that more than this share of a host's distinct documents have, and more than so many of them.
MAX_SHARE, LEAST_DOCUMENTS = 0.1, 10
#: The least share of its words a document must keep.
LEAST_LEFT = 0.3
#: Parts that the documents of a line are dealt over.
SALTS = 16


def _without(text, characters):
    return F.translate(text, characters, "")


def measures(docs, id="doc_id", text="text", host="source"):
    """One row for each row of `docs`: (doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines).

    Words are what lies between ASCII white space; null texts have none. `lines` holds for each line
    with a word its `key`, a hash of the host and of the line in lower case with single spaces, and its
    words `n`; `host` is a hash too. Null hosts are a host of their own. Other columns are not read, whatever their names.
    """
    given = docs.select(
        F.col(id).alias("doc_id"), F.col(host).cast("string").alias("host"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    parts = given.select(
        "*",
        F.array_remove(F.split("text", SPACE + "+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.length(_without(line, _SPACES)) > 0).alias("kept"),
    )
    hashed = parts.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(_without(F.col("text"), _SPACES)).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.size("kept") - F.size(F.array_distinct("kept"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("words"),
        F.transform("kept", lambda line: F.trim(F.regexp_replace(F.lower(line), SPACE + "+", " "))).alias("plain"),
        "host",
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("words") - RUN),
        lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(RUN)]),
    )
    with_windows = hashed.select(
        "doc_id", F.xxhash64("host").alias("host"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.size("words") >= RUN, windows).otherwise(F.array().cast("array<bigint>")).alias("windows"),
        F.transform(
            "plain",
            lambda line: F.struct(
                F.xxhash64("host", line).alias("key"),
                (F.length(line) - F.length(_without(line, " ")) + 1).alias("n"),
            ),
        ).alias("lines"),
    )
    # most texts repeat no window: only the others are sorted
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    with_sorted = with_windows.withColumn("windows", F.when(repeats, placed))
    equal = lambda w, j: F.coalesce(F.get("windows", j)["h"] == w["h"], F.lit(False))
    twice = F.filter("windows", lambda w, j: equal(w, j - 1) | equal(w, j + 1))
    with_starts = with_sorted.withColumn("windows", F.sort_array(F.transform(twice, lambda w: w["i"])))
    covered = F.aggregate(
        F.transform("windows", lambda i, j: F.least(F.lit(RUN), F.coalesce(F.get("windows", j + 1) - i, F.lit(RUN)))),
        F.lit(0).cast("bigint"), lambda total, n: total + n,
    )
    return with_starts.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"), "lines",
    )


def frequent_lines(lines, hosts, max_share=MAX_SHARE, least_documents=LEAST_DOCUMENTS):
    """Keys of (host, key, body) that more than the limit of documents have; documents of equal lines are one.

    The limit of a host is `max_share` of its `documents` (host, documents), and `least_documents` at least.
    """
    counted = (
        lines.select("host", "key", "body").distinct().groupBy("host", "key").agg(F.count(F.lit(1)).alias("found"))
        .where(F.col("found") > least_documents)
    )
    # the others have the least limit; written, so that a host with very many lines is a partition that can be split
    large = keep(hosts.where(F.col("documents") * max_share > least_documents), "rules-hosts")
    return counted.join(large, "host", "left").where(
        F.col("documents").isNull() | (F.col("found") > F.col("documents") * max_share)
    ).select("key")


def judge(
    docs, max_share=MAX_SHARE, least_documents=LEAST_DOCUMENTS, least_left=LEAST_LEFT, least_words=10, most_repeated=20,
    id="doc_id", text="text", host="source",
):
    """Measures of every row of `docs`, what the removal of frequent lines leaves, and the verdict.

    A line (lower case, single spaces) in more than the share `max_share` of a host's distinct documents,
    and in more than `least_documents` of them, is removed from all of them; documents with the same
    lines count once, so copies alone make no line frequent. `base_failed`: fewer than `least_words`
    words, or more than `most_repeated` percent of them in repeated windows. `kept` is false for those,
    and for documents whose frequent lines leave less than the share `least_left` of the words.
    """
    written = keep(
        measures(docs, id, text, host).withColumn("row", F.monotonically_increasing_id()), "rules-measures"
    )
    body = F.xxhash64(F.transform("lines", lambda line: line["key"])).alias("body")
    hosts = written.select("host", body).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))
    lines = written.select("row", "host", body, F.inline("lines"))
    # the lines of a document that many share are dealt over SALTS parts, the few frequent keys copied to each
    frequent = frequent_lines(lines, hosts, max_share, least_documents).select(
        "key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    removed = (
        lines.select("row", "key", "n", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"))
        .join(frequent, ["key", "salt"]).groupBy("row").agg(F.sum("n").alias("removed"))
    )
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("removed", F.lit(0))
    return written.drop("lines", "host").join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), left.cast("bigint").alias("words_left"),
        (~failed & (left >= least_left * F.col("n_words"))).alias("kept"),
    )
