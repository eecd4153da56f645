import random

from evidara.operators import evidence as ev
from evidara.operators import expression as ex


def test_channels_take_whole_rows(spark):
    base = spark.createDataFrame([("a",), ("b",)], "id string")
    channel = spark.createDataFrame([("a", "z", 0.1), ("a", "y", 0.9), ("a", "y", 0.9)], "id string, fam string, score double")
    got = {r.id: (r.fam, r.score, r.has_x_data) for r in ev.merge_channels(base, {"x": channel}).collect()}
    assert got == {"a": ("z", 0.1, True), "b": (None, None, False)}


def _append(existing, entries, statuses):
    taxids, names = {t for t, _ in existing}, {a.split(".")[0] for _, a in existing if a}
    out = []
    for pos, taxid, accession, status in sorted(entries):
        name = (accession or "").split(".")[0]
        if status in statuses and taxid not in taxids and not (name and name in names):
            out.append((taxid, accession))
            taxids.add(taxid)
            names |= {name} - {""}
    return out


def test_inventory_admits_each_genome_once(spark):
    r = random.Random(4)
    existing = [(1, "G1.1"), (2, "G2.1")]
    entries = [(p, r.randrange(60), r.choice([None, "", *[f"G{r.randrange(60)}.{r.randrange(3)}"] * 6]), r.choice(["ok", "ok", "bad"])) for p in range(300)]
    entries += [(1000 + i, 1000 + i // 2, f"C{(i + 1) // 2}.1", "ok") for i in range(40)]  # a chain of conflicts
    got = ev.inventory_append(spark.createDataFrame([(*e, "ok") for e in existing], "taxid long, accession string, status string"),
                              spark.createDataFrame(entries, "pos long, taxid long, accession string, status string"), "b2", ["ok"]).collect()
    assert sorted((x.taxid, x.accession or "") for x in got if x.source_batch == "b2") == sorted((t, a or "") for t, a in _append(existing, entries, ["ok"]))
    assert sorted((x.taxid, x.accession) for x in got if x.source_batch == "") == existing


def test_verdict_lists(spark):
    rows = [("3", '{"class":"B","verdict":"include","n_infiltrations":2,"rf":0.25,"support_drop":1.5,"reasons":["near","low"]}'), ("1", '{"class":"C","verdict":"include"}'),
            ("2", '{"class":"A","verdict":"exclude","reasons":[]}'), ("4", '{"verdict":"include"}'), ("5", "not json"), ("6", None), ("7", '{"class":"B","verdict":"include"}'), ("8", '{"class":"D","verdict":"open"}')]
    got = {r.path: r for r in ex.verdict_lists(spark.createDataFrame(rows, "path string, value string")).collect()}
    assert {p: (r.list, r.place) for p, r in got.items()} == {
        "1": ("keep", 3), "2": ("exclude", 1), "3": ("keep", 1), "4": (None, None), "5": (None, None), "6": (None, None), "7": ("keep", 2), "8": (None, None)}
    assert got["3"].line == "| B | include | 2 | 0.250 | 1.5 | near; low |" and got["1"].line == "| C | include | ? | 0.000 | 0.0 | — |"
    assert got["6"].line == "| ? | ? | ? | 0.000 | 0.0 | — |"


def test_controls_are_found_without_a_text_for_each_word(spark):
    controls = spark.createDataFrame([("7", ["no such"]), ("a", ["big", "gpcr one"]), ("b", ["Amine.2 (x)"]), ("c", ["gpcr on"]), ("d", ["whole text"])], "control string, needles array<string>")
    ranked = spark.createDataFrame([(7, "x", 5), (3, "a gpcr one", 9), (3, "bigger gpcr", 1), (None, "x-GPCR One.", 2), (8, "amine.2 (x)!", 4), (9, "amine.2 (x)y", 3), (5, "whole text", 6)],
                                   "id long, text string, final_rank int")
    got = ev.positive_control_lookup(controls, ranked, ["text"])
    assert sorted(map(tuple, got.collect())) == [("7", "exact_id", 7), ("a", "word_boundary", None), ("b", "word_boundary", 8), ("c", "none", None), ("d", "exact_alias", 5)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Generate explode(array_distinct(" in line]
    assert dealt and all("text#" not in line.rsplit(", false, ", 1)[0].rsplit(", [", 1)[1] for line in dealt)
