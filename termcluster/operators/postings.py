"""Questions, answers, and the scoring of questions by their best answer.

Shape of the work at scale: answers outnumber questions, and one
question may hold a large share of all answers.

* ``score_vectors`` (the input of the clustering) keys every posting by
  its question id and computes the tag index and the best score in one
  hash aggregate: one exchange of pre-aggregated rows, no join, no sort.
* ``question_max_score`` does the same with the tag text. The minimum of a
  text cannot be hash-aggregated, so the tag is first a grouping key (a
  hash aggregate, which flattens any hot question to one row per tag and
  map task) and the minimum is taken over the few rows that are left.

One rule for repeated question ids holds everywhere: they are one question
with the smallest non-null tag in text order, listed or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termcluster.functions.dictionary import Terms, checked, dictionary, is_short
from termcluster.functions.geometry import term_index, text_order_code, text_order_index
from termcluster.operators.ranks import numbered
from termcluster.session import reliable_checkpoint

# Answers per group part of ``question_answer_groups``: a part holds at
# most this many, whatever the number of answers of the question.
DEFAULT_PART = 1 << 16


def questions(postings: DataFrame) -> DataFrame:
    """Questions keyed by id: ``(question_id, tag)``."""
    return (postings.filter(F.col("posting_type") == 1)
            .select(F.col("id").alias("question_id"), "tag"))


def answers(postings: DataFrame) -> DataFrame:
    """Answers keyed by their question: ``(question_id, answer_id, score)``."""
    return (postings.filter((F.col("posting_type") == 2) & F.col("parent_id").isNotNull())
            .select(F.col("parent_id").alias("question_id"),
                    F.col("id").alias("answer_id"), "score"))


def _one_row_questions(postings: DataFrame) -> DataFrame:
    """``(question_id, tag)``, one row per question id. Made unique on the inverted
    id: a join with it then exchanges both sides itself, and only sides that come
    straight from an exchange can be split by AQE where one question is hot."""
    return (questions(postings)
            .groupBy(F.bitwise_not("question_id").alias("inverted"))
            .agg(F.min("tag").alias("tag"))
            .select(F.bitwise_not("inverted").alias("question_id"), "tag"))


def question_answer_pairs(postings: DataFrame) -> DataFrame:
    """Answers with their question's tag: ``(question_id, tag, answer_id,
    score)``.

    An inner join with one row per question id, so each answer appears
    once and no group multiplies into all its pairs; a hot question's
    answers are split by AQE (skew join)."""
    q = _one_row_questions(postings)
    return answers(postings).join(q, "question_id").select("question_id", "tag", "answer_id", "score")


def question_answer_groups(postings: DataFrame, part: int = DEFAULT_PART) -> DataFrame:
    """Answers grouped per question: ``(question_id, tag, part, n,
    answer_ids, scores)``, both arrays ordered by answer id, then score.

    A part holds ``part`` answers, the last one of a question the rest, so a
    question with more answers gives several bounded rows whatever its answer
    ids are (sparse or repeated). ``n`` is the number of answers of the row;
    summing it per question gives the total. Only the answers of questions with
    more than one part are numbered, in ranges and by many tasks."""
    if part <= 0:
        raise ValueError("part size must be positive")
    given = answers(postings).filter(F.col("question_id").isNotNull())
    sizes = given.groupBy("question_id").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.filter(F.col("n") > part).select("question_id")
    placed = given.withColumn("part", F.lit(0).cast("bigint"))
    if not large.isEmpty():
        large = reliable_checkpoint(large)
        split = numbered(given.join(large, "question_id", "left_semi"), ("answer_id", "score"), ("question_id",))
        placed = placed.join(large, "question_id", "left_anti").unionByName(
            split.withColumn("part", F.expr(f"rn div {int(part)}")).drop("rn"))
    placed = placed.join(_one_row_questions(postings), "question_id")
    # the exchange on both keys keeps the join splittable where one question is hot
    grouped = (placed.repartition("question_id", "part")
               .groupBy("question_id", "part", "tag")
               .agg(F.array_sort(F.collect_list(F.struct("answer_id", "score"))).alias("a")))
    return grouped.select(
        "question_id", "tag", "part", F.size("a").cast("bigint").alias("n"),
        F.col("a").getField("answer_id").alias("answer_ids"),
        F.col("a").getField("score").alias("scores"))


def _keyed(postings: DataFrame) -> DataFrame:
    """Every posting under its question's id, read once: ``(question_id,
    is_question, tag, score)`` with the tag of questions and the score of
    answers only; other posting types and keyless answers drop out."""
    is_question, is_answer = F.col("posting_type") == 1, F.col("posting_type") == 2
    return (postings.filter(is_question | is_answer)
            .select(F.when(is_question, F.col("id")).otherwise(F.col("parent_id")).alias("question_id"),
                    is_question.alias("is_question"),
                    F.when(is_question, F.col("tag")).alias("tag"),
                    F.when(is_answer, F.col("score")).alias("score"))
            .filter(F.col("question_id").isNotNull()))


def question_max_score(postings: DataFrame) -> DataFrame:
    """Answered questions with their best answer score:
    ``(question_id, tag, max_score)``. A negative best score stays
    negative; unanswered questions and orphan answers drop out."""
    per_tag = (_keyed(postings).groupBy("question_id", "tag")
               .agg(F.max("score").alias("score"), F.max("is_question").alias("q"),
                    F.min("is_question").alias("q_only")))
    return (per_tag.groupBy("question_id")
            .agg(F.min("tag").alias("tag"), F.max("score").alias("max_score"),
                 F.max("q").alias("q"), F.min("q_only").alias("q_only"))
            .filter(F.col("q") & ~F.col("q_only"))
            .select("question_id", "tag", "max_score"))


def question_tag_index(scored: DataFrame, terms: Terms) -> DataFrame:
    """``(question_id, idx)``: the 0-based index of the question's tag in
    ``terms``; questions with a missing or unlisted tag drop out. A long list,
    or a DataFrame ``(term, idx)``, is joined (see ``functions.dictionary``)."""
    terms = checked(terms)
    if is_short(terms):
        return (scored.select("question_id", term_index(F.col("tag"), terms).alias("idx"))
                .filter(F.col("idx") >= 0))
    return _tagged(scored, terms).select("question_id", "idx")


def _tagged(scored: DataFrame, terms: Terms) -> DataFrame:
    """The questions whose tag the dictionary lists, with its ``idx``."""
    listed = dictionary(scored.sparkSession, terms).withColumnRenamed("term", "tag")
    return scored.join(listed, "tag")


def score_vectors(postings: DataFrame, terms: Terms, spread: int, sort: bool = False) -> DataFrame:
    """2-D integer points ``(id, x, y)`` with ``x = idx * spread`` and
    ``y = best answer score``, one per answered question with a listed tag.

    Questions and answers are rows of the same posting table, so instead
    of aggregating each side and joining them, every posting is keyed by
    its question id and **one** hash aggregate computes both the tag
    (``min`` over the question rows) and the best score (``max`` over the
    answer rows). One scan, one exchange of pre-aggregated rows, no join
    and no sort: a hot question collapses to one row per map task. Ids
    with both parts are the inner-join result.

    The minimum is taken over ``text_order_code``, an integer that orders
    tags as their texts do, as a text could not be hash-aggregated.

    A long list, or a DataFrame ``(term, idx)``, is joined to the questions
    after their best score is known (``question_max_score``): an expression over
    the list would grow with it. ``x`` is a bigint where a list's largest ``x``
    passes 32 bits, and for DataFrames.

    ``sort=True`` adds the global sort by x, then id (with x alone, a range
    partition would hold a whole stratum); nothing downstream needs it."""
    terms = checked(terms)
    if spread <= 0:
        raise ValueError("spread must be positive")
    if is_short(terms):
        both = (_keyed(postings)
                .select("question_id", text_order_code(F.col("tag"), terms).alias("code"), "score")
                .groupBy("question_id")
                .agg(F.min("code").alias("code"), F.max("score").alias("max_score"))
                .select("question_id", text_order_index("code", terms).alias("idx"), "max_score")
                .filter(F.col("idx").isNotNull() & F.col("max_score").isNotNull()))
    else:
        both = _tagged(question_max_score(postings), terms)
    narrow = not isinstance(terms, DataFrame) and (len(terms) - 1) * int(spread) < 1 << 31
    kind = "int" if narrow else "bigint"
    v = both.select(F.col("question_id").alias("id"),
                    (F.col("idx").cast(kind) * F.lit(int(spread)).cast(kind)).alias("x"),
                    F.col("max_score").alias("y"))
    return v.orderBy("x", "id") if sort else v
