import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import corpus, frame
from tests.llm.test_bpe_rounds import odd_texts
from termcluster.llm.pretokens import odd_characters
from termcluster.llm.edit_counts import EDITS, Tree, apply_edit, counter, edited_counts, line_edits

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("seed", range(3))
def test_edits_equal_counting_again(seed):
    count, r = counter(PATH, odd_characters()), random.Random(seed)
    texts = [t for t in odd_texts(seed) if len(t) > 60][:40] + [t or "" for _, t in corpus(seed, n=20)] + ["word " * 3000]
    for text in texts:
        tree, data = Tree(count.leaves(text)), text.encode()
        for _ in range(6):
            a = r.randrange(len(data) + 1)
            b = min(len(data), a + r.choice([0, 1, 5, 40, 700]))
            tree, data, _ = apply_edit(tree, data, a, b, r.choice(["", " ", "x", "new words, 12", "é\n\n", "long " * 200]), count)
            again = Tree(count.leaves(data.decode()))
            assert tree.tokens == again.tokens == len(count.encoding.encode_ordinary(data.decode()))
            assert int(tree.sums[1, 0]) == len(data)


def test_only_the_touched_region_is_encoded():
    count = counter(PATH, odd_characters())
    text = " ".join(f"word{k}" for k in range(20000))
    tree, data, encoded = apply_edit(Tree(count.leaves(text)), text.encode(), 50000, 50004, "other", count)
    assert encoded < 4000 and tree.tokens == len(count.encoding.encode_ordinary(data.decode()))


def test_line_edits_through_spark(spark):
    rows = [(1, "a b\na b\na b\nc"), (2, "x\n\n\ny"), (3, None), (4, ""), (None, "é é\né é"), (1, "one\none")] + corpus(2, n=20)
    got = edited_counts(frame(spark, rows), line_edits(F.col("text")), PATH).collect()

    def plain(t):
        lines = (t or "").split("\n")
        return "\n".join(x for k, x in enumerate(lines) if not k or x != lines[k - 1])

    assert sorted(r.text_after for r in got) == sorted(plain(t) for _, t in rows)
    encode = counter(PATH, odd_characters()).encoding.encode_ordinary
    assert all(r.n_tokens_after == len(encode(r.text_after)) == r.tree[1] and r.n_bytes_after == len(r.text_after.encode()) for r in got)


def test_given_edits_nulls_and_empty_table(spark):
    edits = F.lit(None).cast(EDITS)
    assert edited_counts(frame(spark, []), edits, PATH).collect() == []
    (r,) = edited_counts(frame(spark, [(1, "some text")]), edits, PATH).collect()
    assert r.n_edits == 0 and r.n_tokens == r.n_tokens_after and r.text_after == "some text"
    odd = F.array(F.struct(F.lit(-5).alias("start"), F.lit(2).alias("end"), F.lit(None).cast("string").alias("text")), F.struct(F.lit(8).alias("start"), F.lit(99).alias("end"), F.lit("!").alias("text")))
    (r,) = edited_counts(frame(spark, [(1, "some text")]), odd, PATH).collect()
    assert r.text_after == "me tex!" and r.n_edits == 2


def test_characters_whose_class_the_library_has_otherwise(spark):
    count = counter(PATH, odd_characters())
    odd = [c for c in map(chr, range(0x80, 0x33000)) if not 0xD800 <= ord(c) < 0xE000 and count.split.odd(c)]
    assert len(odd) > 1000
    texts = ["".join(f"a{c}'s {c}'s 1{c}" for c in odd[k:k + 50]) for k in range(0, len(odd), 50)]
    got = edited_counts(frame(spark, list(enumerate(texts))), line_edits(F.col("text")), PATH).collect()
    assert {r.id: r.n_tokens for r in got} == {i: len(count.encoding.encode_ordinary(t)) for i, t in enumerate(texts)}
