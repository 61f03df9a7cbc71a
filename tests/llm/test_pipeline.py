import corpus_pipeline as C
from pyspark.sql import functions as F
from test_jaccard_join import brute

from kinloom.llm import common, mixing, secret_scan
from kinloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in C.STAGES:
        before = docs.collect()
        docs = common.stored(stage(spark, docs, SF), "test")
        after = docs.collect()
        if name != C.STAGES[-1][0]:
            assert docs.columns == COLUMNS
        if name == "quality classifier":
            left = {r.doc_id for r in after}
            good = [i for i, q in marks.items() if q == 1]
            assert sum(i in left for i in good) >= 0.95 * len(good)
            assert sum(i in left for i, q in marks.items() if q == 0) <= 0.2 * max(1, len(marks) - len(good))
        elif name == "n-gram Jaccard join":
            rows = sorted(before, key=lambda r: r.doc_id)
            stay = {rows[root].doc_id for _, root in brute([r.text for r in rows])}
            assert sorted(r.doc_id for r in after) == sorted(stay)
        elif name == "secret scans":
            assert len(after) == len(before)
            texts = {r.doc_id: r.text for r in before}
            for r in after:
                assert not secret_scan.scan(r.text) and r.n_chars == len(r.text)
                assert (r.text == texts[r.doc_id]) == (not secret_scan.scan(texts[r.doc_id]))
        elif name == "mixing sources":
            words = lambda rows: sum(len((r.text or "").split()) for r in rows)
            texts = {r.doc_id: r.text for r in before}
            assert all(texts[r.doc_id] == r.text for r in after)
            of = {r.doc_id: r.source for r in before}
            targets = {of[r.doc_id]: r.target for r in mixing.mix(spark.createDataFrame(before)).collect()}
            for source, target in targets.items():
                own = [r for r in before if r.source == source]
                longest = max(len((r.text or "").split()) for r in own)
                assert abs(words(r for r in after if r.source == source) - target) <= longest
                assert any(r.source == source for r in after) or not words(own)
        else:
            assert len(after) == len(before) and docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_run_and_registration(spark):
    assert C.run(spark, SF).count() > 0
    assert len(C.STAGES) == 5
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 14))


def test_null_columns(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "a b c", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in C.STAGES[1:4]:
        docs = common.stored(stage(spark, docs, SF), "nulls")
    assert docs.filter(F.col("doc_id") == 1).count() == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in C.STAGES:
        docs = common.stored(stage(spark, docs, SF), "empty")
        assert docs.count() == 0, name


def test_odd_rows_through_all_stages(spark):
    words = "the cat sat on the mat and the dog was with it in the house of the old man"
    long = " ".join(f"{words} {i}" for i in range(9000))
    rows = [(1, words, "en", "a", len(words)), (1, words, "en", "a", len(words)), (None, words + " too", None, None, None),
            (3, None, "en", "a", None), (4, "", "en", "b", 0), (5, long, "en", "b", len(long)), (6, "token = abcdef0123456789abcdef", "fr", None, 30)]
    docs = spark.createDataFrame([(*r, "x", "y", 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, keep string, times string, row int")
    seen = {}
    for name, stage in C.STAGES:
        docs = common.stored(stage(spark, docs, SF), "odd")
        seen[name] = docs.collect()
        if name != C.STAGES[-1][0]:
            assert docs.columns == [*COLUMNS, "keep", "times", "row"]
    # equal rows and the one that differs by a word are one group; texts without words stay until the mix
    left = seen["n-gram Jaccard join"]
    assert sum((r.text or "").startswith(words) and len(r.text) < 100 for r in left) == 1
    assert sum(not r.text for r in left) == sum(not r.text for r in seen["quality classifier"]) == 2
    mixed = seen["mixing sources"]
    assert all(r.text for r in mixed) and {r.text for r in mixed} <= {r.text for r in seen["secret scans"]}
    assert len(seen["BPE encoding and decoding"]) == len(mixed)


def test_run_removes_its_tables(spark):
    before = set(common._made)
    C.run(spark, SF).count()
    made = [p for p in common._made if p not in before]
    assert len(made) == len(C.STAGES) - 1 and all("-stage" in p for p in made)
