"""Section formats, read in splits of a few bytes, against a plain reading of whole files."""

import math
import random
import re

import pytest

from evidara.sources import sections as sc


@pytest.fixture
def splits(spark):
    """Splits of 64 bytes, so that files, sections and their marks fall apart everywhere."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "64")
    spark.conf.set(names[1], "0")
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def name(path):
    return path.rsplit("/", 1)[1]


def plain_sections(text, mark):
    """(section, head, line) of the lines that are no marks."""
    out, number, head, open_ = [], 0, None, False
    for line in text.split("\n"):
        if not line.strip():
            continue
        if re.match(mark, line):
            head, open_ = line, False
            continue
        if not open_:
            number, open_ = number + 1, True
        out.append((number, head, line))
    return out


def files_of(folder, seed, lines):
    rng = random.Random(seed)
    texts = {f"{seed}-{i}.txt": "\n".join(lines(rng, k) for k in range(rng.choice([0, 1, 7, 60]))) + rng.choice(["", "\n", "\n\n"]) for i in range(6)}
    for k, v in texts.items():
        (folder / k).write_text(v)
    return texts


@pytest.mark.parametrize("seed", range(4))
def test_sections_in_small_splits(spark, splits, tmp_path, seed):
    texts = files_of(tmp_path, seed, lambda rng, k: rng.choice(["###", "", "   ", f"# {k}", f"a{k}\tb", f"c{k} " + "x" * rng.choice([0, 30, 200])]))
    rows = sc.read_placed(spark, str(tmp_path))
    got = sc.with_sections(rows, rows["value"].startswith("#"))
    assert rows.rdd.getNumPartitions() > 8
    want = sorted((f, *r) for f, text in texts.items() for r in plain_sections(text, "#"))
    key = lambda r: (r[0], r[1], r[2] or "", r[3])
    assert sorted(((name(r.path), r.section, r["head"], r.value) for r in got.collect()), key=key) == sorted(want, key=key)


def test_section_over_many_splits(spark, splits, tmp_path):
    """One section holds nearly all lines of a file; splits without a mark pass the head on."""
    (tmp_path / "a").write_text(">Cluster 7\n" + "".join(f"{i}\t300aa, >m{i}... {'*' if i == 0 else 'at 91.5%'}\n" for i in range(300)) + ">Cluster 8\n\n>Cluster 9\n0\t1aa, >z... *\n")
    got = {r.member: r for r in sc.cluster_members(sc.read_placed(spark, str(tmp_path))).collect()}
    assert len(got) == 301 and {(r.cluster, r.label) for m, r in got.items() if m != "z"} == {(0, "7")}
    assert (got["z"].cluster, got["z"].label, got["z"].is_rep, got["z"].identity) == (1, "9", True, None)
    assert got["m5"].identity == 91.5 and not got["m5"].is_rep and got["m0"].is_rep


def test_anchor_blocks(spark, splits, tmp_path):
    (tmp_path / "a.anchors").write_text("top\tline\t2\n###\nA1\tB1\t1e-5\nA2 \tB2\tx\n###\n\n###\nA3\tB3\nlonely\n#\n")
    got = sorted((r.block, r.gene_a, r.gene_b, None if math.isnan(r.evalue) else r.evalue) for r in sc.anchor_blocks(sc.read_placed(spark, str(tmp_path))).collect())
    assert got == [(1, "top", "line", 2.0), (2, "A1", "B1", 1e-5), (2, "A2", "B2", None), (3, "A3", "B3", None)]


def test_reports_in_one_file(spark, splits, tmp_path):
    hit = "  {} h{} some protein  98.5 {} 1E-9  123.4  0.5  120  1-120  3-122 (300)\n"
    (tmp_path / "all.hhr").write_text("".join(f"Query         q{q} x\nMatch_columns 9\n\n No Hit Prob E-value\n" + "".join(hit.format(i, i, "1E-3" if i % 2 else "2") for i in range(1, 9)) + "\nNo 1\n>h1\nQ q 1 ACD 3 (9)\n" for q in range(12)))
    got = sorted((r.query, r.no, r.hit, r.prob, r.evalue, r.score) for r in sc.profile_hits(sc.read_placed(spark, str(tmp_path)), 0.01).collect())
    assert got == sorted((f"q{q}", i, f"h{i}", 98.5, 1e-3, 123.4) for q in range(12) for i in range(1, 9, 2))


def test_aligned_residues(spark, splits, tmp_path):
    (tmp_path / "a").write_text("# x\nTM-score\t0.75\nref\tcand\tres\n" + "".join(f"{i}\t{i + 5}\t{'ACDE'[i % 4].lower()}\n" for i in range(90)) + "7\t1\tW\n8\t-\t-\nTM-score\t0.1\n1 2 3 4\n")
    (tmp_path / "b").write_text("nothing aligned\ntm-score n/a\n")
    rows = sc.aligned_residues(sc.read_placed(spark, str(tmp_path))).collect()
    got = {r.position: (r.tm_score, r.residue) for r in rows if name(r.path) == "a"}
    assert got == {i: (0.75, "W" if i == 7 else "ACDE"[i % 4]) for i in range(90)}
    assert [(r.tm_score, r.position, r.residue) for r in rows if name(r.path) == "b"] == [(None, None, None)]


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty").write_text("")
    rows = sc.read_placed(spark, str(tmp_path))
    assert sc.anchor_blocks(rows).count() == sc.cluster_members(rows).count() == sc.profile_hits(rows, 1.0).count() == sc.aligned_residues(rows).count() == 0
