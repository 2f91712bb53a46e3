"""Columns of the input that have the names an operator uses itself."""

from crawlframe.llm import linededup, simhash

CLASHING = "doc_id long, text string, _doc long, _print long, _gone long, _own_print long, _id long, _DOC_ long, i int, m int, doc long, print long, lines_removed int, a long, b long, fp long, root long"


def rows(spark, texts):
    return spark.createDataFrame([(d, t, *range(7, 22)) for d, t in texts], CLASHING)


def test_line_runs_keep_columns_of_such_names(spark):
    run = "\n".join("some words of a line that is repeated here " + str(k) for k in range(8))
    docs = rows(spark, [(1, f"{run}\nfirst"), (2, f"{run}\nsecond"), (3, None), (None, "x")])
    got = {r.doc_id: r for r in linededup.without_repeated_runs(docs).collect()}
    assert got[1].text == f"{run}\nfirst" and got[2].text == "second" and got[2].lines_removed == 8
    assert all((r._doc, r._print, r._gone, r._own_print, r._id) == (7, 8, 9, 10, 11) for r in got.values())


def test_kept_documents_keep_columns_of_such_names(spark):
    docs = rows(spark, [(1, "one two three four"), (1, "other words in this text"), (2, "one two three four"), (None, "alone among the texts")])
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    found = got.collect()
    assert sorted((r.doc_id or 0, r.text) for r in found) == [(0, "alone among the texts"), (1, "one two three four"), (1, "other words in this text")]
    assert all((r._doc, r._print, r._gone, r._own_print, r._id) == (7, 8, 9, 10, 11) for r in found)
