import datetime
from itertools import product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from yearwheel.operators import checks, cube

DIMS = ["a", "b", "c", "d"]


def brute_force(records, dims):
    out = {}
    for record in records:
        for keep in product((True, False), repeat=len(dims)):
            key = tuple(record[i] if k else "All" for i, k in enumerate(keep))
            out[key] = out.get(key, 0) + record[-1]
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(*[st.sampled_from("xyz")] * 4, st.integers(0, 100)), min_size=1, max_size=30),
    st.sampled_from([1, 2, 3, 10]),
)
def test_cube_equals_brute_force(table, records, step):
    base = table("a string, b string, c string, d string, v bigint", records)
    got = {tuple(r)[:4]: r.v for r in cube.dimension_cube(base, DIMS, ["v"], step=step).collect()}
    assert got == brute_force(records, DIMS)


def test_steps_do_not_change_the_levels(table, rows):
    base = table("a string, b string, c string, d string, v bigint", [("p", "q", "r", "s", 1), ("p", "t", "r", "u", 2)])
    flat = cube.dimension_cube(base, DIMS, ["v"], level="level", step=10)
    assert rows(cube.dimension_cube(base, DIMS, ["v"], level="level", step=3)) == rows(flat)
    assert flat.select("level").distinct().count() == 16


def test_missing_and_literal_members_stay_apart_from_totals(table, rows):
    base = table("a string, b string, v bigint", [(None, "x", 1), ("All", "x", 2), ("k", "x", 4)])
    got = rows(cube.dimension_cube(base, ["a", "b"], ["v"], step=1).where("b = 'x'"), "a", "v")
    assert got == [(None, 1), ("All", 2), ("All", 7), ("k", 4)]


def test_parts_of_the_cube(table, rows):
    base = table("a string, b string, v bigint", [("k", "x", 1), ("l", "x", 2), ("l", "y", 3)])
    full = rows(cube.dimension_cube(base, ["a", "b"], ["v"]))
    parts = rows(cube.partial_cube(base, ["a", "b"], ["v"])) + rows(cube.grand_total(base, ["a", "b"], ["v"])) + rows(base)
    assert sorted(parts) == sorted(full)


def test_combinations_leave_out_the_empty_and_the_full_set():
    for n in range(2, 7):
        assert len(cube.grouping_combinations([str(i) for i in range(n)])) == 2**n - 2


def test_grouping_count(table):
    base = table("a string, b string, c string, v bigint", [("k", "x", "m", 1), ("l", "x", "n", 2)])
    counts = checks.grouping_count(cube.dimension_cube(base, ["a", "b", "c"], ["v"], level="level"), "level")
    assert {r.n_sets for r in counts.collect()} == {8}
    assert counts.agg(F.sum("n_rows")).first()[0] == cube.dimension_cube(base, ["a", "b", "c"], ["v"]).count()


def test_empty_base_has_no_total(table):
    base = table("a string, b string, v bigint", [])
    assert cube.dimension_cube(base, ["a", "b"], ["v"]).count() == 0
    assert cube.grand_total(base, ["a", "b"], ["v"]).count() == 0


def test_any_number_of_dimensions_of_any_type(table):
    dims = [f"d{i}" for i in range(12)]
    schema = ", ".join([f"{d} string" for d in dims[2:]]) + ", d0 int, d1 date, v bigint"
    base = table(schema, [(*["x"] * 10, 7, datetime.date(2020, 1, 2), 3)])
    full = cube.dimension_cube(base, dims, ["v"], level="level")
    assert full.count() == 2**12 and dict(full.dtypes)["d0"] == "string"
    finest = full.where("level = 0").first()
    assert (finest.d0, finest.d1, finest.v) == ("7", "2020-01-02", 3)


def test_partial_cube_is_stepped(table, plan):
    base = table("a string, b string, c string, d string, v bigint", [("p", "q", "r", "s", 1)])
    assert cube.partial_cube(base, DIMS, ["v"]).count() == 2**4 - 2
    assert plan(cube.partial_cube(base, DIMS, ["v"])).count("Expand") == 2


def test_each_step_of_the_cube_combines_before_its_shuffle(table, plan):
    base = table("a string, b string, c string, d string, v bigint", [("p", "q", "r", "s", 1)])
    text = plan(cube.dimension_cube(base, DIMS, ["v"]))
    assert text.count("Expand") == 2 and text.count("Exchange hashpartitioning") == 2
    assert text.count("partial_sum") == 2


def test_dependent_dimensions_are_copied(table, rows):
    """With a determines b and c determines d, the cube is the same, from fewer summed combinations."""
    data = [(f"a{k % 5}", f"b{k % 5 % 2}", k % 3, f"c{k % 7}", None if k % 7 > 4 else f"d{k % 7 % 2}", k) for k in range(200)]
    base = table("a string, b string, x int, c string, d string, n long", data)
    dims = ["x", "b", "d", "a", "c"]
    full = cube.dimension_cube(base, dims, ["n"], "level")
    pruned = cube.dimension_cube(base, dims, ["n"], "level", follows=[("a", "b"), ("c", "d")])
    assert rows(full) == rows(pruned)
    sets = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("null, ") + df._jdf.queryExecution().optimizedPlan().toString().count("[null")
    assert sets(pruned) < sets(full)


def test_parts_keep_pairs_together():
    assert cube._parts(["y", "p", "g", "s"], 3, [("p", "g")]) == [["y", "p", "g"], ["s"]]
    assert cube._parts(["y", "d", "g", "p"], 3, [("p", "g")]) == [["y", "d"], ["p", "g"]]
    assert cube._parts(list("abcdef"), 3, []) == [list("abc"), list("def")]
