"""What the n-gram join shuffles: packed texts, once a pass, and no files left of it."""

import random

import brute
import pyarrow as pa
from cohortlab.llm import ngram_join
from cohortlab.sources import tables
from cohortlab.sources.tables import checkpoint_table


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(k).getName().startswith("shuffle_") for k in range(files.size()))


def test_a_written_table_leaves_no_shuffle_files(spark):
    setting = spark.conf.get(tables.CLEANUP)
    before = shuffle_files(spark)
    out = checkpoint_table(spark.range(5000).repartition(5, "id").groupBy("id").count(), "counted")
    assert shuffle_files(spark) <= before
    assert out.count() == 5000 and spark.conf.get(tables.CLEANUP) == setting


def test_packed_texts_come_back_whole():
    rng = random.Random(4)
    texts = ["", "é ü 漢字 " * 7, " ".join(str(rng.random()) for _ in range(200_000)), "a", ""] + [str(k) * k for k in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"]).slice(1)
    packed, = ngram_join._packed([batch])
    got = []
    for lo, hi, data, offsets in ngram_join.unpacked(packed.slice(2)):
        assert lo == len(got) and len(offsets) == hi - lo + 1
        got += [bytes(data[s:e]).decode() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
    assert got == texts[3:]
    assert sum(map(len, packed.column("packed").to_pylist())) < 0.6 * sum(len(t.encode()) for t in texts)


def test_texts_are_shuffled_packed_and_compared_once(spark, monkeypatch, tmp_path):
    rng = random.Random(2)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    rows = [(i, " ".join(base[:80 + i % 9])) for i in range(12)] + [(40, ""), (41, "one two")]
    held, deal, compare = [], ngram_join.dealt, ngram_join._compare
    marks = tmp_path / "compared"

    def counted(size, percent):
        run = compare(size, percent)

        def noted(batches):
            batches = list(batches)
            with open(marks, "a") as f:
                for b in batches:
                    f.writelines(f"{row}\n" for row in b.select(["p", "i", "j", "x"]).to_pylist())
            return run(iter(batches))
        return noted

    monkeypatch.setattr(ngram_join, "dealt", lambda stars, what: (held.append(what.columns), deal(stars, what))[1])
    monkeypatch.setattr(ngram_join, "_compare", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_components(df).collect()}
    assert got == brute.ngram_components(rows)
    assert held == [["doc_id", "size", "packed"]]
    seen = marks.read_text().splitlines()
    assert len(seen) == len(set(seen)) > 0 and len({c for _, c in got.values()}) > 1
