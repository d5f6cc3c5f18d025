import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sessionloom.operators import cube, locations, products, sessions, users, visits
from sessionloom.operators.grain import session_grain
from sessionloom.operators.sessions import BUCKETS, STEP_BUCKETS, TIME_BUCKETS

from conftest import plan_of, rows

DAY = 1_556_150_400_000
SCHEMA = ("uid string, sid string, access_time bigint, en string, pl string, country string, province string, "
          "city string, pid string")


def make(spark, events):
    """Events as dicts; anything not given has a default."""
    base = dict(uid="u", sid="s", ms=0, en="e_pv", pl="pc", country="C", province="P", city="X", pid=None)
    full = [{**base, **e} for e in events]
    return spark.createDataFrame(
        [(e["uid"], e["sid"], DAY + e["ms"], e["en"], e["pl"], e["country"], e["province"], e["city"], e["pid"])
         for e in full], SCHEMA)


def random_events(seed, n=400):
    rnd = random.Random(seed)
    some = lambda *xs: rnd.choice(xs)
    found = []
    for _ in range(n):
        province = some("P", "Q")
        found.append(dict(
            uid=some(None, *[f"u{i}" for i in range(12)]), sid=some(None, *[f"s{i}" for i in range(40)]),
            ms=rnd.randrange(2 * 86_400_000), en=some("e_l", "e_pv", "e_bp", "e_s"), pl=some("pc", "ios", None),
            province=province, city=province + some("1", "2", "3"), country=some("C", "D"),
            pid=some(None, " ", "1", "2", "3", "4", "5")))
    return found


@pytest.fixture(scope="module", params=[1, 2])
def random_table(request, spark):
    events = random_events(request.param)
    # a third of all rows without session id, from many users
    events += [dict(uid=f"v{i}", sid=None, ms=i, en="e_pv") for i in range(200)]
    return make(spark, events).cache()


def test_bounce_is_judged_within_its_group(spark):
    grain = session_grain(make(spark, [dict(city="X", ms=1), dict(city="Y", ms=2), dict(sid="t", city="Y", ms=3)]))
    got = {(r["pl"], r["province"], r["city"]): r for r in locations.stats_device_location(grain).collect()}
    for pl in ("pc", "all"):
        assert got[pl, "P", "X"]["bounce_sessions"] == 1
        assert got[pl, "P", "Y"]["bounce_sessions"] == 2
        assert got[pl, "P", "all"]["bounce_sessions"] == 1
        assert got[pl, "all", "all"]["bounce_sessions"] == 1
        assert got[pl, "all", "all"]["session_count"] == 2


def test_missing_user_and_session_are_one_member_each(spark):
    grain = session_grain(make(spark, [dict(uid=None, sid=None), dict(uid=None, sid=None, ms=5), dict(uid="a", sid="b")]))
    got = users.stats_user(grain).filter("pl = 'all'").first()
    assert (got["active_users"], got["session_count"]) == (2, 2)


def test_missing_platform_is_its_own_group(spark):
    grain = session_grain(make(spark, [dict(pl=None, sid="a"), dict(pl="pc", sid="b")]))
    for stat in (users.stats_user(grain), sessions.session_aggr_stat(grain)):
        assert rows(stat, "pl", "session_count") == sorted([("all", 2), ("pc", 1), (None, 1)], key=repr)


def test_session_over_two_platforms_and_midnight(spark):
    grain = session_grain(make(spark, [dict(pl="pc", ms=86_399_000), dict(pl="ios", ms=86_400_500)]))
    got = rows(sessions.session_metrics(grain), F.col("dt").cast("string"), "pl", "length_s")
    assert got == sorted([("2019-04-25", "all", 0), ("2019-04-25", "pc", 0), ("2019-04-26", "all", 0),
                          ("2019-04-26", "ios", 0)])


EDGES = [0, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801, 5000]


def test_length_buckets(spark):
    events = []
    for s in EDGES:
        # 999 ms more still floor to the same second
        events += [dict(sid=f"s{s}", ms=0, en="e_l"), dict(sid=f"s{s}", ms=s * 1000 + 999, en="e_l")]
    hist = sessions.session_histogram(sessions.session_metrics(session_grain(make(spark, events)))).filter(
        "pl = 'all'").first()
    for name, (_, low, high) in TIME_BUCKETS.items():
        assert hist[name] == sum(low <= e and (high is None or e <= high) for e in EDGES), name
    assert all(hist[name] == 0 for name in STEP_BUCKETS)


def test_step_buckets(spark):
    steps = [0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 100]
    events = [dict(sid=f"s{n}", ms=i, en="e_pv" if i % 2 else "e_bp") for n in steps for i in range(n)]
    events += [dict(sid=f"s{n}", ms=0, en="e_s") for n in steps]
    hist = sessions.session_histogram(sessions.session_metrics(session_grain(make(spark, events)))).filter(
        "pl = 'pc'").first()
    for name, (_, low, high) in STEP_BUCKETS.items():
        assert hist[name] == sum(low <= n and (high is None or n <= high) for n in steps), name
    assert hist["session_count"] == len(steps)


def test_histogram_adds_up(spark, random_table):
    metrics = sessions.session_metrics(session_grain(random_table))
    hist = sessions.session_histogram(metrics)
    with_steps = {(r["dt"], r["pl"]): r["n"] for r in metrics.filter("steps > 0").groupBy("dt", "pl").agg(
        F.count("*").alias("n")).collect()}
    for r in hist.collect():
        assert sum(r[b] for b in TIME_BUCKETS) == r["session_count"]
        assert sum(r[b] for b in STEP_BUCKETS) == with_steps.get((r["dt"], r["pl"]), 0)
    packed = sessions.histogram_packed(hist).filter("pl = 'all'").first()["packed"]
    assert packed.startswith("session_count=") and packed.count("|") == len(BUCKETS)


def brute_levels(events, dims, levels):
    """Users, sessions, bounces, launches, views and product views, by loops over sets."""
    uids, sids, sums = defaultdict(set), defaultdict(lambda: defaultdict(int)), defaultdict(lambda: [0, 0, 0])
    for e in events:
        for level in levels:
            key = (str(e["dt"]), *[e[d] if d in level else "all" for d in dims])
            uids[key].add(e["uid"])
            sids[key][e["sid"]] += 1
            sums[key][0] += e["en"] == "e_l"
            sums[key][1] += e["en"] in ("e_pv", "e_bp")
            sums[key][2] += e["en"] == "e_bp"
    return {k: (len(uids[k]), len(sids[k]), sum(n == 1 for n in sids[k].values()), *sums[k]) for k in uids}


def collected(table):
    return [r.asDict() for r in table.withColumn("dt", F.to_date(F.timestamp_millis("access_time"))).collect()]


def test_device_location_equals_brute_force(spark, random_table):
    dims = ["pl", "country", "province", "city"]
    expected = brute_levels(collected(random_table), dims, locations.DEVICE_LEVELS)
    got = locations.stats_device_location(session_grain(random_table)).collect()
    assert {(str(r["dt"]), *[r[d] for d in dims]): (r["active_users"], r["session_count"], r["bounce_sessions"])
            for r in got} == {k: v[:3] for k, v in expected.items()}
    assert len(got) == len(expected)


def test_flow_equals_brute_force(spark, random_table):
    dims = ["country", "province", "city"]
    expected = brute_levels(collected(random_table), dims, locations.FLOW_LEVELS)
    got = locations.location_flow(session_grain(random_table)).collect()
    assert {(str(r["dt"]), *[r[d] for d in dims]): (r["uv"], r["sn"], r["on"], r["nu"], r["pv"])
            for r in got} == {k: v[:5] for k, v in expected.items()}


@pytest.mark.parametrize("views, at", [("product", 5), ("all", 4)])
def test_user_stats_equal_brute_force(spark, random_table, views, at):
    expected = brute_levels(collected(random_table), ["pl"], users.LEVELS)
    got = users.stats_user(session_grain(random_table), views).collect()
    assert {(str(r["dt"]), r["pl"]): (r["active_users"], r["session_count"], r["new_install_users"], r["session_length"])
            for r in got} == {k: (v[0], v[1], v[3], v[at] // v[1]) for k, v in expected.items()}


def test_rollup_shuffles_members_not_copies(spark, random_table):
    """Three exchanges of member rows, none of their copies, then two of counts per place."""
    plan = plan_of(locations.stats_device_location(session_grain(random_table)))
    lines = plan.splitlines()
    exchanges = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    first_copies = [i for i, x in enumerate(lines) if "Generate explode(CASE WHEN" in x][-1]  # plans print upside down
    assert sum(i < first_copies for i in exchanges) == 2
    assert "hashpartitioning(dt" in lines[next(i for i in exchanges if i > first_copies)]
    assert "Expand" not in plan and "Python" not in plan


def test_event_cube(spark):
    table = make(spark, [dict(en="e_l"), dict(en="e_pv", ms=1), dict(en="e_pv", pl="ios"), dict(en=None, pl=None)])
    got = {(r["pl"], r["en"]): r["event_count"] for r in cube.event_cube(table).collect()}
    assert got == {("pc", "e_l"): 1, ("pc", "e_pv"): 1, ("ios", "e_pv"): 1, (None, None): 1, ("pc", "all"): 2,
                   ("ios", "all"): 1, (None, "all"): 1, ("all", "e_l"): 1, ("all", "e_pv"): 2, ("all", None): 1,
                   ("all", "all"): 4}


def test_top_products_ties_blanks_and_cities(spark):
    views = [dict(en="e_bp", pid=p, city=c, ms=i) for i, (p, c) in enumerate(
        [("4", "Y"), ("3", "X"), ("2", "X"), ("1", "Y"), ("9", "Z"), ("9", "X"), (" ", "X"), ("", "X"), (None, "X")])]
    views += [dict(en="e_pv", pid="4", ms=50 + i) for i in range(9)]
    got = products.area_top3_product(make(spark, views))
    assert rows(got, "product_id", "browser_count", "city_infos") == [("1", 1, "Y"), ("2", 1, "X"), ("9", 2, "X,Z")]
    assert plan_of(got).count("WindowGroupLimit") == 2


def brute_sessions(events, gap, openers=None):
    out = {}
    for uid in {u for u, *_ in events}:
        moments = sorted({t for u, t, _ in events if u == uid})
        number, before = 0, None
        for t in moments:
            opens = openers is None or any(e in openers for u, x, e in events if u == uid and x == t)
            if before is None or (t - before > gap and opens):
                number += 1
            before = t
            out[uid, t] = number
    return out


@pytest.mark.parametrize("gap", [1_000, 120_000, 600_000])
@pytest.mark.parametrize("openers", [None, ["e_pv"]])
def test_sessions_of_bare_events(spark, gap, openers):
    rnd = random.Random(gap)
    events = []
    for u in range(6):
        t = -gap * 3
        for _ in range(120):
            t += rnd.choice([0, 1, gap // 3, gap - 1, gap, gap + 1, 3 * gap, 40 * gap])
            events.append((f"u{u}", t, rnd.choice(["e_pv", "e_s"])))
    table = spark.createDataFrame(events, "uid string, access_time bigint, en string")
    expected = brute_sessions(events, gap, openers)
    got = visits.sessionize(table, gap, openers).collect()
    assert len(got) == len(events)
    assert all(r["session_no"] == expected[r["uid"], r["access_time"]] for r in got)
    spans = defaultdict(list)
    for u, t, _ in events:
        spans[u, expected[u, t]].append(t)
    summary = visits.session_summary(table, gap, openers).collect()
    assert {(r["uid"], r["session_no"]): (r["start_ts"], r["end_ts"], r["n"]) for r in summary} == {
        k: (min(v), max(v), len(v)) for k, v in spans.items()}


def test_sessions_around_1970_and_of_missing_users(spark):
    table = spark.createDataFrame([("u", -900), ("u", 900), ("u", 950), (None, 5)], "uid string, access_time bigint")
    got = visits.sessionize(table, 1000)
    assert rows(got, "uid", "access_time", "session_no") == sorted(
        [("u", -900, 1), ("u", 900, 2), ("u", 950, 2), (None, 5, 1)], key=repr)


def test_first_visit_keeps_one_row_per_user_early(spark):
    table = spark.createDataFrame([("u", 5, 2), ("u", 5, 1), ("v", 1, 3), ("u", 9, 0)],
                                  "uid string, access_time bigint, event_id bigint")
    got = visits.first_visit(table)
    assert rows(got) == [("u", 5, 1), ("v", 1, 3)]
    assert "WindowGroupLimit" in plan_of(got)
