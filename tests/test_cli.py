"""The two command-line programs over small text files."""

from termcluster import __main__ as cli
from termcluster.params import ClusterParams

HEAD, TAIL = "<page> <title>", "</text> </page> "


def test_rank_program(spark, tmp_path):
    p = tmp_path / "articles.dat"
    texts = ["a small Groovy script calls an Erlang node", "the build mixes Java with Scala sources",
             "every Scala trait may carry code", "lazy lists: Haskell has them, Java got streams",
             "old Java servers keep running"]
    p.write_text("".join(f"{HEAD}Title {i}: a page</title><text>{t}{TAIL}\n" for i, t in enumerate(texts)))
    out = []
    res = cli.rank(spark, str(p), ["Scala", "Java", "Groovy", "Haskell", "Erlang", "Cobol"], out=out.append)
    assert res["separate counts"][:2] == [("Java", 3), ("Scala", 2)]
    assert res["separate counts"][-1] == ("Cobol", 0)
    assert res["inverted index"] == res["one shuffle"] == res["separate counts"][:-1]
    assert len(out) == 3


def test_cluster_program(spark, tmp_path):
    p = tmp_path / "postings.csv"
    lines = [f"1,{q},,,0,{('Java', 'Scala')[q % 2]}" for q in range(1, 41)]
    lines += [f"2,{1000 + q},,{q},{(q * 37) % 90}," for q in range(1, 41)]
    lines += ["1,5000,,,3,Cobol", "2,5001,,5000,9"]          # unlisted tag: dropped
    p.write_text("\n".join(lines) + "\n")
    out = []
    run = cli.cluster(spark, str(p), ClusterParams(terms=("Java", "Scala"), kernels=4), out=out.append)
    assert out[0].startswith("k-means: ") and out[1] == "Resulting clusters:"
    assert sum(r["size"] for r in run.report().collect()) == 40
