"""What languages are learned from, and which documents are kept as known."""

import sys
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[2])]

from areapanel.llm import language_id as L  # noqa: E402

KIND = "doc_id long, lang string, text string"


def spelled(n, letters):
    """A word of its own for each number."""
    out = ""
    while n or not out:
        n, k = divmod(n, len(letters))
        out += letters[k]
    return out


def test_copies_are_one_text(spark):
    copies = [(k, "xx", f"copy {spelled(c, 'abcdefghij')}") for c in range(20) for k in range(1000 * c, 1000 * c + 150)]
    others = [(50_000 + k, "xx", f"other {spelled(k, 'klmnopqrst')}") for k in range(200)]
    sample = L.training_text(spark.createDataFrame(copies + others, KIND))["xx"].split()
    # All 48 places hold texts that differ.
    assert len(sample) == 2 * L.SAMPLE_DOCS and len(set(sample)) == L.SAMPLE_DOCS + 2


def many_languages(n):
    """Documents of n languages, each with letters of its own."""
    out = []
    for k in range(n):
        letters = [chr(0x4E00 + 20 * k + j) for j in range(20)]
        text = [" ".join(spelled(7 * d + 13 * j + 400, letters) for j in range(12)) for d in range(6)]
        out += [(100 * k + d, f"l{k:03d}", t) for d, t in enumerate(text)]
    return out


def test_every_label_is_learned(spark):
    rows = many_languages(70)
    docs = spark.createDataFrame(rows, KIND)
    said = {r["doc_id"]: r["lang_pred"] for r in L.language_id(docs).collect()}
    assert said == {d: lang for d, lang, _ in rows}
    assert L.keep_known(docs).count() == len(rows)


def test_blocks_say_the_same(spark, monkeypatch):
    rows = many_languages(6) + [(9001, None, None), (9002, "l000", " 12 "), (9002, "l000", "x"), (None, None, "the end")]
    rows += [(8000, None, rows[0][2]), (8001, None, rows[0][2][:20] + rows[10][2][:30])]
    docs = spark.createDataFrame(rows, KIND)

    def told():
        said = [(r["doc_id"], r["held_out"], r["lang_pred"], round(r["score"], 9), r["phrase_rate"]) for r in L.language_id(docs).collect()]
        return sorted(said, key=str), sorted(L.keep_known(docs).collect(), key=str)

    whole = told()
    assert len(L.blocks(L.training_text(docs))) == 1
    monkeypatch.setattr(L, "CELLS", 60_000)
    assert 1 < len(L.blocks(L.training_text(docs))) < 7
    assert told() == whole
    assert {d for d, *_ in whole[1]} >= {8000} and len(whole[0]) == len(rows)


def test_short_clean_texts_stay(spark, monkeypatch):
    rows = [(k, "en", "we all go to the sea and be as is one of a few " + spelled(k, "abcdefghij")) for k in range(30)]
    short = ["a", "I", "to", "az", "the", "seg", "is it"]
    foreign = ["ж", "жш", "жшю", "жшющ жшющ", "- 1 -", None]
    asked = [(1000 + k, None, t) for k, t in enumerate(short)] + [(2000 + k, None, t) for k, t in enumerate(foreign)]
    more = [(3000 + k, "de", "wir gehen alle an das meer " + spelled(k, "klmnopqrst")) for k in range(30)]
    docs = spark.createDataFrame(rows + more + asked, KIND)
    right = {d for d, _, _ in rows + more} | {1000 + k for k in range(len(short))}
    assert {r["doc_id"] for r in L.keep_known(docs).collect()} == right
    monkeypatch.setattr(L, "CELLS", 1)
    assert {r["doc_id"] for r in L.keep_known(docs).collect()} == right
