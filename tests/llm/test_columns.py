"""Extra columns may have any name that Spark can hand to Arrow tasks (none with a dot), those used inside included."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ordermill.llm import near_dedup, substrings

INNER = (
    "doc variant spans __doc __variant __spans _kept _n_words _n_removed found_doc found_variant digest __digest nth __nth tokens membership uses use "
    "__tokens __membership __uses node component cluster kept stays component_id n_shingles statistics posterior pattern key hash label domain"
).split()


@pytest.fixture(scope="module")
def crowded(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(60)
    return docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(INNER)])


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:4])
def test_stages_keep_all_columns_whatever_their_names(spark, small, crowded, name, stage):
    out = stage(spark, crowded, small)
    assert out.columns == crowded.columns
    plain = stage(spark, crowded.select("doc_id", "text", "lang", "source", "n_chars"), small)
    key = ["doc_id", "text", "n_chars"]
    assert sorted(map(tuple, out.select(*key).collect())) == sorted(map(tuple, plain.select(*key).collect()))
    assert {r["_kept"] for r in out.select("_kept").collect()} <= {INNER.index("_kept")}


def test_a_taken_result_name_is_refused(crowded):
    with pytest.raises(ValueError, match="_kept"):
        substrings.remove_repeats(crowded)
    assert substrings.remove_repeats(crowded, into="new_").columns[-3:] == ["new_n_words", "new_n_removed", "new_kept"]


def test_one_id_with_two_texts_is_kept_twice_but_stays_once(spark):
    """``kept`` says whether the id is its component's; ``stays`` picks one row."""
    words = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(7, words), (7, f"{words} more"), (8, words)], "doc_id long, text string")
    got = near_dedup.near_duplicates(docs, size=4, percent=80).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(7, 7, True), (7, 7, True), (8, 7, False)]
    assert sum(r.stays for r in near_dedup.judged(docs, size=4, percent=80).collect()) == 1


def test_pairs_at_the_threshold_are_linked(spark):
    """4,000 pairs of texts that share exactly 80 of 100 shingles: none may be lost."""
    def text(i, tail):
        return " ".join([*(f"p{i}w{k}" for k in range(83)), *(f"{tail}{i}w{k}" for k in range(10))])

    rows = [(2 * i + j, text(i, t)) for i in range(4000) for j, t in enumerate("xy")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=4, percent=80).collect()
    # 80 shared shingles and 10 of each side's own: 80 of 100, the threshold itself.
    assert sum(r.component_id == r.doc_id for r in got) == 4000
