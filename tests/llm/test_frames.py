"""The functions that remove or replace rows, on frames that are not read
from files: a created frame and a union."""
import pytest

import corpus_pipeline
from costledger.llm.common import identified, without
from costledger.llm.decontam import decontaminated
from costledger.llm.langid import accepted
from costledger.llm.pii import redacted

SF = "/root/testdata/sf0.001"
WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()


@pytest.fixture(scope="module")
def rows(spark):
    """Rows that every stage removes something of, and a personal address."""
    base = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    passage = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    long = base[0][1]
    odd = [(9000, "12 34 !!", "en"), (9001, long, base[0][2]), (9002, long + " ", base[0][2]), (9003, long[:-1], base[0][2]),
           (9004, passage, "en"), (9005, "write to a@b.co " + " ".join(WORDS), "en")]
    return base + odd


def frames(spark, rows, scratch):
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    for name, part in (("low", "doc_id < 9002"), ("high", "doc_id >= 9002")):
        made.where(part).write.parquet(f"{scratch}/{name}")
    read = spark.read.parquet
    return {"created": made, "union": read(f"{scratch}/low").unionByName(read(f"{scratch}/high"))}


def test_removal_does_not_depend_on_the_frame(spark, rows, scratch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    stages = {"accepted": accepted, "decontaminated": lambda d: decontaminated(d, items),
              "exact_dedup": lambda d: corpus_pipeline.exact_dedup(spark, d, SF),
              "simhash_near_dedup": lambda d: corpus_pipeline.simhash_near_dedup(spark, d, SF)}
    gone = {"accepted": 9000, "decontaminated": 9004, "exact_dedup": 9001, "simhash_near_dedup": 9001}
    docs = frames(spark, rows, scratch)
    for stage, fn in stages.items():
        want = None
        for name, frame in docs.items():
            out = fn(frame)
            assert out.columns == frame.columns
            left = sorted(r.doc_id for r in out.collect())
            want = left if want is None else want
            assert left == want and gone[stage] not in left and 9005 in left, (stage, name)


def test_redaction_does_not_depend_on_the_frame(spark, rows, scratch):
    for name, frame in frames(spark, rows, scratch).items():
        text = {r.doc_id: r.text for r in redacted(frame).collect()}
        assert len(text) == len(rows) and text[9005] == "write to [EMAIL] " + " ".join(WORDS), name


def test_marks_of_another_copy_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="_metadata"):
        without(docs, identified(docs, "rid").select("rid"))
