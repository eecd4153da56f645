"""Label operators whose rows are dealt to tasks by their number."""

from evidara.operators import labels as lb
from evidara.operators import stats as st


def test_more_rows_go_to_more_tasks_with_the_same_verdicts(spark, monkeypatch):
    rows = [(a, f"c{a % 3}", f"f{a % 4}", a % 2 == 0, g if g else None) for a in range(30) for g in range(a % 5)]
    anchors = spark.createDataFrame(rows, "accession long, clade string, family string, characterized boolean, og long").coalesce(1)
    sizes = anchors.groupBy("og").count().withColumnRenamed("count", "size")

    def verdicts():
        got = lb.cross_clade_concordance(anchors, "c0"), lb.gate_loo(anchors, sizes, "leave_one", 50, 1, "off"), lb.gate_loo(anchors, sizes, "leave_clade", 50, 1, "off")
        return [sorted(map(str, g.collect())) for g in got]

    plain = verdicts()
    monkeypatch.setattr(st, "TASK_DRAWS", 5)
    assert st.tasks_for(lb.MET_FAMILIES * len(rows), anchors) > 40 and verdicts() == plain and all(plain)
