"""Text jobs in batch: words, tags, bigrams, phrases, line files."""

from __future__ import annotations

from pyspark.sql import functions as F

from heronlake.functions.text import char_ngrams, normalize_text
from heronlake.operators import text as ops
from heronlake.plans import oracle as o
from heronlake.registry import job
from heronlake.session import fresh_dir, written_once
from heronlake.sources.files import read_lines, write_lines
from heronlake.sources.tables import blacklist, doc_lines, documents, lexicon, status, table


def words(spark, sf_dir):
    return ops.tokenize(doc_lines(spark, sf_dir))


def line_files(spark, sf_dir) -> str:
    return written_once(spark, sf_dir, "lines",
                        lambda path: write_lines(doc_lines(spark, sf_dir).select("value"), path))


@job("scan_text_lines", f"WITH {o.LINES} SELECT value, count(*) AS n FROM doc_lines GROUP BY value")
def scan_text_lines(spark, sf_dir):
    lines = read_lines(spark, line_files(spark, sf_dir) + "/part-*")
    return lines.groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@job("sink_text_roundtrip", f"WITH {o.WORDS} SELECT concat('(', word, ',', CAST(count(*) AS VARCHAR), ')') AS value "
                            "FROM words GROUP BY word")
def sink_text_roundtrip(spark, sf_dir):
    counts = ops.word_count(words(spark, sf_dir))
    path = fresh_dir(spark, "counts")
    write_lines(counts.select(F.concat(F.lit("("), "word", F.lit(","), F.col("n").cast("string"),
                                       F.lit(")")).alias("value")), path)
    return read_lines(spark, path)


@job("tokenize_words", f"WITH {o.WORDS} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, word FROM words")
def tokenize_words(spark, sf_dir):
    return words(spark, sf_dir)


@job("filter_long_words", f"WITH {o.WORDS} SELECT doc_id, word FROM words WHERE length(word) > 4")
def filter_long_words(spark, sf_dir):
    return ops.long_words(words(spark, sf_dir)).select("doc_id", "word")


COUNTS = f"WITH {o.WORDS} SELECT word, count(*) AS n FROM words"


@job("word_count", f"{COUNTS} GROUP BY word")
def word_count(spark, sf_dir):
    return ops.word_count(words(spark, sf_dir))


@job("word_count_sorted", f"{COUNTS} WHERE length(word) > 4 GROUP BY word ORDER BY n DESC, word")
def word_count_sorted(spark, sf_dir):
    return ops.word_count(ops.long_words(words(spark, sf_dir))).orderBy(F.desc("n"), "word")


@job("word_count_sorted_by_key",
     f"WITH {o.WORDS} SELECT count(*) AS n, word FROM words WHERE length(word) > 4 GROUP BY word ORDER BY n DESC, word")
def word_count_sorted_by_key(spark, sf_dir):
    swapped = ops.word_count(ops.long_words(words(spark, sf_dir))).select("n", "word")
    return swapped.orderBy(F.desc("n"), "word")


@job("word_count_top10", f"{COUNTS} WHERE length(word) > 4 GROUP BY word ORDER BY n DESC, word LIMIT 10")
def word_count_top10(spark, sf_dir):
    return ops.top_k(ops.word_count(ops.long_words(words(spark, sf_dir))), "n", 10, "word")


@job("words_not_blacklisted", f"WITH {o.WORDS}, {o.BLACKLIST} SELECT word, count(*) AS n FROM words "
                              "WHERE word NOT IN (SELECT word FROM blacklist) GROUP BY word")
def words_not_blacklisted(spark, sf_dir):
    # counted first, so the anti join sees one row per word
    return ops.word_count(words(spark, sf_dir)).join(blacklist(spark), "word", "left_anti")


@job("hashtags_extract", f"WITH {o.TAGS} SELECT id, substr(tag, 2) AS tag FROM tags")
def hashtags_extract(spark, sf_dir):
    return ops.tag_rows(status(spark, sf_dir).select("id", "text"), strip=True)


@job("inline_rows", f"""WITH {o.TAGS}, {o.LEXICON}
    SELECT word, score, count(*) AS n FROM tags JOIN lexicon ON substr(tag, 2) = word GROUP BY word, score""")
def inline_rows(spark, sf_dir):
    tags = ops.tag_rows(status(spark, sf_dir).select("text"), strip=True)
    counts = tags.groupBy("tag").agg(F.count(F.lit(1)).alias("n"))
    return (counts.join(lexicon(spark), F.col("tag") == F.col("word"))
            .select("word", "score", "n"))


@job("char_bigrams", """WITH chars AS (SELECT string_split(text, '') AS c FROM documents WHERE text <> ''),
    grams AS (SELECT c[i] || coalesce(c[i + 1], '') AS bigram
      FROM (SELECT c, unnest(range(1, greatest(len(c), 2))) AS i FROM chars))
    SELECT bigram, count(*) AS n FROM grams GROUP BY bigram""")
def char_bigrams(spark, sf_dir):
    grams = documents(spark, sf_dir).select(F.explode(char_ngrams(F.col("text"))).alias("bigram"))
    return grams.groupBy("bigram").agg(F.count(F.lit(1)).alias("n"))


NORMAL = """normal AS (SELECT doc_id, lang, array_to_string(
    list_filter(s, lambda c, i: NOT (i > 2 AND s[i - 1] = c AND s[i - 2] = c)), '') AS text
    FROM (SELECT doc_id, lang, string_split(lower(text), '') AS s FROM documents))"""


@job("text_normalize", f"WITH {NORMAL} SELECT doc_id, text FROM normal")
def text_normalize(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", normalize_text(F.col("text")).alias("text"))


STOP_LIST = ", ".join(f"'{w}'" for w in ops.STOPWORDS)


@job("text_phrases", rf"""WITH {NORMAL}, toks AS (SELECT lang, list_filter(
      regexp_split_to_array(text, '[^\p{{L}}#]+'), lambda t: t <> '' AND t NOT IN ({STOP_LIST})) AS t FROM normal)
    SELECT lang, t[i] || ' ' || t[i + 1] AS phrase, count(*) AS n
    FROM (SELECT lang, t, unnest(range(1, len(t))) AS i FROM toks) GROUP BY ALL""")
def text_phrases(spark, sf_dir):
    found = ops.phrases(documents(spark, sf_dir).select("lang", "text"), "text")
    return found.groupBy("lang", "phrase").agg(F.count(F.lit(1)).alias("n"))


def digit_messages(df, id_col, words=20):
    digits = F.transform(
        F.sequence(F.lit(0), F.lit(words - 1)),
        lambda j: F.pmod(F.pmod(F.col(id_col) * 7919 + j * 104729, F.lit(1000003)), F.lit(10)).cast("string"))
    return df.withColumn("value", F.array_join(digits, " "))


@job("gen_digit_messages", """SELECT event_id AS id, array_to_string(list_transform(range(0, 20),
      lambda j: CAST(((event_id * 7919 + j * 104729) % 1000003) % 10 AS VARCHAR)), ' ') AS value FROM events""")
def gen_digit_messages(spark, sf_dir):
    """Twenty digits for each event, a fixed arithmetic hash of its id."""
    return digit_messages(table(spark, sf_dir, "events").select(F.col("event_id").alias("id")), "id")
