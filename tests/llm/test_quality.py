import random

from pyspark.sql import functions as F

from foliomart.llm import quality
from tests.llm import brute
from tests.llm.conftest import prose

BASE = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_measures_against_plain_python(docs, rows, got):
    assert got(quality.judge(docs), *BASE) == brute.op5_base([(r[0], r[1]) for r in rows])


def word(i, k):
    return "".join(chr(97 + (i * 67 + k * 13 + j * j) // 26**j % 26) for j in range(4)) + chr(97 + k % 26) + chr(97 + i % 26)


def page(i, extra="", n=60):
    return " ".join(word(i, k) for k in range(n)) + extra


def frame(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, source) for i, t in enumerate(texts)], "doc_id long, text string, source string")


def test_boilerplate_goes_and_depleted_documents_with_it(spark, got):
    line = "Follow us on 12 channels and win"
    texts = [page(i) + f"\n{line}\n" + page(i + 500) for i in range(12)]
    # almost nothing but boilerplate: several lines that stand in ever other surroundings
    lines = [f"menu {k} entry of the site with a long and boring name for all" for k in "abcdefgh"]
    for i in range(12):
        texts.append("\n".join(lines[(i * 3 + j * (1, 3, 5)[i % 3]) % 8] for j in range(8)) + f"\nown words {i}")
    judged = quality.judge(frame(spark, texts)).cache()
    kept = {r["doc_id"]: r for r in judged.collect()}
    assert all(kept[i]["kept"] and kept[i]["removed_lines"] == [1] for i in range(12))
    assert all(not kept[i]["kept"] and kept[i]["left_words"] < 25 for i in range(12, 24))
    left = {r[0]: r[1] for r in quality.cleaned(judged).select("doc_id", "text").collect()}
    assert left[3] == page(3) + "\n" + page(503) and 15 not in left


def test_numbers_and_case_do_not_hide_a_line(spark):
    texts = [page(i) + f"\n PAGE {10 + i} of   99 of our Great book\n" + page(i + 500) for i in range(12)]
    assert quality.judge(frame(spark, texts)).where("left_words = 120").count() == 12


def test_copies_are_left_to_the_duplicate_stages(spark):
    text = "\n".join(page(k, n=20) for k in range(8))
    near = [text.replace(word(3, 7), f"edit{chr(97 + i)}").replace(word(i % 8, 1) + " ", "") for i in range(30)]
    judged = quality.judge(frame(spark, [text] * 30 + near))
    assert judged.where("kept AND removed_lines IS NULL").count() == 60


def test_hosts_are_counted_apart_and_null_is_a_host(spark):
    texts = [page(i) + "\nthe very same line\n" + page(i + 500) for i in range(24)]
    df = frame(spark, texts).withColumn("source", F.when(F.col("doc_id") < 8, "a").when(F.col("doc_id") < 12, "n"))
    judged = quality.judge(df)
    assert {r[0] for r in judged.where("removed_lines IS NOT NULL").select("doc_id").collect()} == set(range(12, 24))


def test_repeated_rows_are_one_document(spark):
    texts = [page(0) + "\nthe very same line\n" + page(500 + i) for i in range(30)]
    df = frame(spark, texts).withColumn("doc_id", F.lit(1).cast("long"))
    assert quality.judge(df).where("removed_lines IS NOT NULL").count() == 0


def test_empty_table_and_clashing_columns(spark, nothing):
    assert quality.judge(nothing).count() == 0
    df = frame(spark, [page(1), None]).select("*", *[F.lit("?").alias(c) for c in ("kept", "line", "host", "n_words", "_row")])
    found = quality.judge(df)
    assert found.where("host = '?' AND line = '?'").count() == 2 and found.where("kept").count() == 1


def test_lines_go_wherever_they_stand(spark):
    """Blank lines between paragraphs, a fixed block below 1,000 texts, and one document full of the line."""
    foot = "\n".join(f"the {k} line of a footer that never varies" for k in "abcde")
    texts = [page(i * 7, n=40) + "\n\nFollow us and win\n\n" + page(i * 7 + 3, n=40) for i in range(12)]
    texts += ["\n".join(["Follow us and win"] * 500) + "\n" + page(91)]
    judged = {r["doc_id"]: r for r in quality.judge(frame(spark, texts)).collect()}
    assert all(judged[i]["removed_lines"] == [2] for i in range(12)) and len(judged[12]["removed_lines"]) == 500
    rnd = random.Random(6)
    own = [prose(rnd, 60) for _ in range(1000)]
    judged = quality.judge(frame(spark, [f"{t}\n{foot}" for t in own]))
    assert judged.where("kept AND removed_lines = array(1, 2, 3, 4, 5) AND left_words = 60").count() == 1000


def same_as_brute(spark, texts):
    """Verdicts and texts left for (text, source) pairs."""
    rows = [(i, t, s) for i, (t, s) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r["doc_id"]: (r["kept"], r["text"]) for r in _verdicts(df)}
    assert found == {d: (k, t if k else None) for d, (k, t) in brute.op5_verdict(rows).items()}
    return found


def _verdicts(df):
    judged = quality.judge(df)
    left = quality.cleaned(judged).select("doc_id", "text")
    return judged.select("doc_id", "kept").join(left, "doc_id", "left").collect()


def test_a_block_goes_however_much_of_the_page_it_fills(spark):
    """A fixed block of 240 words under 200 pages each with 110, 40, 20 and 12 words of their own."""
    rnd = random.Random(8)
    block = "\n".join(prose(rnd, 12) for _ in range(20))
    texts = []
    for n in (110, 40, 20, 12):
        own = [prose(rnd, n) for _ in range(200)]
        texts += [(f"{x}\n{block}" if i % 2 else f"{block}\n\n{x}", str(n)) for i, x in enumerate(own)]
    found = same_as_brute(spark, texts)
    assert all(found[i][0] == (i < 200) for i in range(800)) and all(block not in found[i][1] for i in range(200))


def test_copies_and_their_edits_stay_beside_other_pages(spark):
    """Exact and near copies of one text, among them some with three changed lines on end, and a common footer."""
    rnd = random.Random(9)
    lines = [prose(rnd, 14) for _ in range(12)]
    foot = "the one footer of the site\nand its second line"
    texts = ["\n".join(lines)] * 15
    for _ in range(45):
        x, at, n = list(lines), rnd.randrange(10), rnd.randint(1, 3)
        x[at : at + n] = [line.replace(" ", f" edit{chr(97 + rnd.randrange(26))}{rnd.randrange(10**6)} ", 1) for line in x[at : at + n]]
        texts.append("\n".join(x))
    texts += [f"{prose(rnd, 70)}\n{foot}" for _ in range(40)]
    found = same_as_brute(spark, [(t, "s") for t in texts])
    assert all(k for k, _ in found.values()) and all(found[i][1] == texts[i] for i in range(60))
    assert all("footer" not in found[i][1] for i in range(60, 100))


def test_rows_without_an_id_are_told_apart_by_text(spark):
    texts = [page(i) + "\nthe very same line\n" + page(i + 500) for i in range(24)]
    df = frame(spark, texts).withColumn("doc_id", F.lit(None).cast("long"))
    assert quality.judge(df).where("left_words = 120").count() == 24
    assert quality.judge(frame(spark, [texts[0]] * 24).withColumn("doc_id", F.lit(None).cast("long"))).where("left_words = 124").count() == 24
