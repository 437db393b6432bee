"""Line dedup reaches lines of any length."""

from skerry.llm import lines
from tests.llm import brute
from tests.llm.conftest import SCHEMA


def docs(spark, texts):
    return spark.createDataFrame([(k, t, "en", "web", len(t)) for k, t in texts.items()], SCHEMA)


def test_short_lines_recur_too(spark):
    texts = {
        1: "All rights reserved.\nalpha\n12\n\nPage 1 of 9",
        2: "All  rights reserved. \nbeta\n13\n\nPage 2 of 9",
        3: "All rights\nreserved.\n12\n\nPage three of 9",
        4: "alpha\nall rights reserved.\n12 13\nrights All reserved.",
    }
    got = {x.doc_id: x.kept_text for x in lines.without_recurring(docs(spark, texts)).collect()}
    # a line within one document may repeat, blank lines stay, numbers alone are not one template
    assert got == {1: texts[1], 2: "beta\n13\n", 3: "All rights\nreserved.\n\nPage three of 9", 4: "all rights reserved.\n12 13\nrights All reserved."}


def test_every_short_length(spark):
    for n in range(1, 5):
        line = " ".join(f"word{chr(97 + k)}" for k in range(n))
        got = {x.doc_id: x.n_dropped for x in lines.report(docs(spark, {k: f"{line}\nown{chr(97 + k)}" for k in range(3)})).collect()}
        assert got == {0: 0, 1: 1, 2: 1}


def test_documents_equal_brute_force(spark, documents, texts):
    first = {}
    for k in sorted(texts):
        for line in (texts[k] or "").split("\n"):
            for key in brute.template_keys(line):
                first.setdefault(key, k)
    want = {k: [i for i, line in enumerate((t or "").split("\n")) if any(first[key] < k for key in brute.template_keys(line))] for k, t in texts.items()}
    assert any(len(line.split()) < lines.MIN_TOKENS for k, gone in want.items() for line in [texts[k].split("\n")[i] for i in gone])
    assert {x.doc_id: x.lost_lines for x in lines.without_recurring(documents).collect()} == want


def test_documents_of_short_lines_stay(spark):
    shared = "this line stands in many documents"
    texts = {1: shared, 2: f"{shared}\na verse\nof short lines", 3: f"x = 1\n{shared}", 4: f"{shared}\n漢字の文章です", 5: f"{shared}\n \n\t", 6: "", 7: "a verse of one"}
    got = {x.doc_id: (x.text, x.n_chars) for x in lines.rewrite(docs(spark, texts)).collect()}
    want = {1: shared, 2: "a verse\nof short lines", 3: "x = 1", 4: "漢字の文章です", 6: "", 7: "a verse of one"}
    assert got == {k: (t, len(t)) for k, t in want.items()}
