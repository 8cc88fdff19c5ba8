"""The pipeline from the tables to its last rows, against what each stage's brute-force version leaves."""

import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[2]), str(Path(__file__).resolve().parent)]

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from areapanel.llm import language_id as L  # noqa: E402
from areapanel.llm.mixing import mix, mixing_report  # noqa: E402
from areapanel.llm.sharding import SHARDS  # noqa: E402
from test_leaks import brute as leaks  # noqa: E402

KIND = "doc_id long, source string, lang string, text string, _key string, row int, shard string"


def spoken(draw, start, n=60):
    return " ".join("".join(chr(start + draw.randrange(20)) for _ in range(draw.randrange(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    draw, folder = random.Random(3), str(tmp_path_factory.mktemp("corpus"))
    rows = [(k, f"s{k % 3}", lang, spoken(draw, start)) for k, (lang, start) in enumerate([("aa", 97), ("bb", 0x430)] * 60)]
    item = " ".join(f"abc{chr(97 + k)}" for k in range(20))
    rows += [(500 + k, "s0", "aa", rows[0][3]) for k in range(30)]
    rows += [(600 + k, "s1", "aa", rows[2][3] + f" tail{'abc'[k]}") for k in range(3)]
    rows += [(700, "s2", "aa", f"{rows[4][3]} {item}"), (701, "s2", "aa", rows[6][3]), (701, "s2", "aa", rows[6][3])]
    rows += [(800, "s0", "aa", None), (801, "s0", None, " 12 ,"), (802, None, None, ""), (None, "s1", "aa", rows[8][3]), (None, "s1", "aa", spoken(draw, 97))]
    spark.createDataFrame([(*r, "k", 1, "x") for r in rows], KIND).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, item


def test_run(spark, tables):
    folder, rows, item = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = corpus_pipeline.run(spark, folder).collect()
    assert set(got[0].asDict()) == set(docs.columns) | {"shard", "slot"}

    known = [r for r in rows if any(c.isalpha() for c in r[3] or "")]
    numbered = [(n, r[3]) for n, r in enumerate(sorted(known, key=lambda r: (r[0] is None, r[0] or 0)))]
    kept = [numbered[n] for n in sorted({root for _, size, root in brute.jaccard(numbered)})]
    leaking = {d for d, *_ in leaks(kept, [(1, item)])}
    clean = sorted(text for n, text in kept if n not in leaking)
    assert 0 < len(leaking) and len(clean) < len(rows) - 30

    # Stages one to three leave these texts; the mix repeats them by their own rates.
    found = Counter(r["text"] for r in got)
    assert set(found) <= set(clean)
    seen = docs.where(docs.text.isin(clean)).dropDuplicates(["text"])
    before = spark.read.parquet(_stage_folder(spark, 2))
    assert sorted(r["text"] for r in before.collect()) == clean == sorted(r["text"] for r in seen.collect())
    taken = Counter()
    for r, t in zip(sorted(before.collect(), key=_id), sorted(mixing_report(before).collect(), key=_id)):
        taken[r["text"]] += t["taken"] // t["size"]
    assert {k: n for k, n in taken.items() if n} == found

    sizes = Counter(r["shard"] for r in got)
    assert len(sizes) == min(SHARDS, len(got)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert all(sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n)) for s, n in sizes.items())


def _id(r):
    return (r["doc_id"] is None, r["doc_id"] or 0)


def _stage_folder(spark, number):
    """The newest run's folder of a stage."""
    from areapanel.session import shared_folder

    root = shared_folder(spark).removeprefix("file:")
    newest = max(Path(root).glob("corpus-*"), key=lambda p: p.stat().st_mtime)
    return str(next(newest.glob(f"{number}_*")))


def test_empty_tables(spark, tables, tmp_path):
    folder = tables[0]
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_of_blocks_do_not_clash(spark, tables, monkeypatch):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet").withColumnRenamed("_key", "key")
    whole = sorted(map(str, L.keep_known(docs).collect()))
    monkeypatch.setattr(L, "CELLS", 1)
    assert sorted(map(str, L.keep_known(docs).collect())) == whole


def test_rows_without_id_draw_apart(spark):
    docs = spark.createDataFrame([(None, f"s{k % 4}", f"word{k} " * 10) for k in range(4000)], "doc_id long, source string, text string")
    report = mixing_report(docs).collect()
    near = Counter()
    for r in report:
        near[r["source_size"], round(r["target"], 6)] += r["taken"]
    assert sum(near.values()) == pytest.approx(60_000, rel=0.05)
    by_source = Counter(r["source"] for r in mix(docs).collect())
    assert [10 * by_source[f"s{k}"] for k in range(4)] == pytest.approx([20_000, 40_000 / 3, 20_000 / 3, 20_000], rel=0.1)
    first = hashlib.md5(b"word0 " * 10).hexdigest()
    want = int(hashlib.md5(f"0:text {first}".encode()).hexdigest()[:8], 16) / 2**32
    one = next(r for r in mixing_report(docs.where("text LIKE 'word0 %'")).collect())
    assert one["taken"] == 10 * (1 + (want < 0.5))
