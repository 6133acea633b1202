import random

from pagelake.operators.reach import reachable

EDGES = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y"), ("d", None),
         ("a", "b")] + [("hub", f"n{i}") for i in range(50)] + [("d", "hub")]


def run(spark, **kw):
    edges = spark.createDataFrame(EDGES, "src string, dst string")
    seeds = spark.createDataFrame([("a",), ("a",), ("alone",)], "node string")
    return {r["node"]: r["round"] for r in reachable(seeds, edges, **kw).collect()}


def test_chain_cycle_and_unreachable_part(spark):
    got = run(spark)
    assert {k: v for k, v in got.items() if not k.startswith("n")} == {
        "a": 0, "alone": 0, "b": 1, "c": 2, "d": 3, "hub": 4}
    assert sum(k.startswith("n") for k in got) == 50


def test_round_limit(spark):
    assert set(run(spark, max_rounds=2)) == {"a", "alone", "b", "c"}


def test_a_reused_folder_counts_no_earlier_run(spark, tmp_path):
    run(spark, work_dir=str(tmp_path / "w"))
    seeds = spark.createDataFrame([("x",)], "node string")
    edges = spark.createDataFrame([("x", "d"), ("d", "w"), ("x", "d")], "src string, dst string")
    got = reachable(seeds, edges, work_dir=str(tmp_path / "w")).collect()
    assert {r["node"]: r["round"] for r in got} == {"x": 0, "d": 1, "w": 2}


def test_a_long_chain_takes_few_rounds(spark, tmp_path):
    """Ten thousand next pages, a short cut into them, a branch and two rings."""
    n = 10_000
    edges = [(f"p{i}", f"p{i + 1}") for i in range(n)] + [("p0", "s"), ("s", "p9000"), ("p9500", "side")]
    edges += [("r1", "r2"), ("r2", "r1"), (f"p{n}", "q1"), ("q1", "q2"), ("q2", "q1")]
    df = spark.createDataFrame(edges, "src string, dst string")
    seeds = spark.createDataFrame([("p0",), ("p700",)], "node string")
    got = {r["node"]: r["round"] for r in reachable(seeds, df, work_dir=str(tmp_path / "w")).collect()}
    want = {f"p{i}": i if i < 700 else min(i - 700, i - 9000 + 2 if i >= 9000 else n) for i in range(n + 1)}
    want |= {"s": 1, "side": want["p9500"] + 1, "q1": want[f"p{n}"] + 1, "q2": want[f"p{n}"] + 2}
    assert got == want
    (folder,) = (tmp_path / "w").iterdir()
    assert len(list(folder.glob("reached/number=*"))) + len(list(folder.glob("back=*"))) < 50
    near = reachable(seeds, df, max_rounds=1500, work_dir=str(tmp_path / "v")).collect()
    assert {r["node"]: r["round"] for r in near} == {k: v for k, v in want.items() if v <= 1500}


def test_random_graphs(spark):
    rng = random.Random(8)
    for n, m in ((12, 14), (40, 45), (60, 62)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(None, 1), (2, None)]
        seeds = [rng.randrange(n) for _ in range(2)]
        want, now, k = {}, set(seeds), 0
        while now:
            want |= dict.fromkeys(now, k)
            now = {d for s, d in edges if s in now and d is not None} - set(want)
            k += 1
        got = reachable(
            spark.createDataFrame([(s,) for s in seeds] + [(None,)], "node int"),
            spark.createDataFrame(edges, "src int, dst int"),
        ).collect()
        assert {r["node"]: r["round"] for r in got} == want
    assert not any(t.name.startswith("reach_") for t in spark.catalog.listTables())
