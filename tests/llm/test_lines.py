from evenledger.llm.lines import drop_boilerplate

SCHEMA = "doc_id long, text string, source string, host string, lines int"


def rows():
    out = []
    for k in range(40):
        out.append((k, f"Home\n\nown line {k}\n  Home  \nHome", "a", "z", 1))
    for k in range(40, 44):
        out.append((k, f"Home\nown {k}", "b", None, 1))
    out += [(50, None, "a", None, 1), (51, "", "a", None, 1), (52, "Home", None, None, 1), (53, "Home", "", None, 1)]
    return out


def test_ratio_by_host(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    for most in (10, 0):
        got = {r.doc_id: r for r in drop_boilerplate(docs, 50, 3, broadcast_lines=most).collect()}
        assert got[3].text == "\nown line 3" and (got[3].n_lines, got[3].n_dropped) == (5, 3)
        assert got[41].text == "own 41"
        assert got[50].text == got[51].text == "" and got[50].n_lines == 1
        assert got[52].text == got[53].text == "Home"
        assert len(got) == 48


def test_at_the_bound_a_line_stays(spark):
    docs = spark.createDataFrame([(k, "x" if k < 5 else f"y{k}", "a", None, 0) for k in range(50)], SCHEMA)
    assert drop_boilerplate(docs, 10, 3).agg({"n_dropped": "sum"}).first()[0] == 0
    assert drop_boilerplate(docs, 9, 3).agg({"n_dropped": "sum"}).first()[0] == 5


def test_empty_table(spark):
    assert drop_boilerplate(spark.createDataFrame([], SCHEMA)).collect() == []


def test_copies_count_once(spark):
    same = "first of the text\nlast of the text"
    given = [(k, same, "a", None, 0) for k in range(30)] + [(k, f"Home\nown {k}", "a", None, 0) for k in range(30, 90)]
    given += [(k, same, "b", None, 0) for k in range(90, 93)] + [(k, f"own {k}", "b", None, 0) for k in range(93, 110)]
    docs = spark.createDataFrame(given, SCHEMA)
    for most in (100, 0):
        got = {r.doc_id: r.text for r in drop_boilerplate(docs, 10, 3, broadcast_lines=most, copies_once=True).collect()}
        assert all(got[k] == same for k, text, *_ in given if text == same) and got[30] == "own 30"
    assert drop_boilerplate(docs, 10, 3).where("text = ''").count() == 33
