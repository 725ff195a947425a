import datetime as dt
import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from test_functions import python_lcs
from tideline.operators import (
    constraints, dedup, diversity, filters, history, ledger, marts, quality, skew, summary,
    territory,
)

T0 = dt.datetime(2024, 1, 1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# Territory -------------------------------------------------------------------------------------


def python_ratio(a, b):
    total = len(a) + len(b)
    return 100.0 if not total else (1 - (total - 2 * python_lcs(a, b)) / total) * 100


def python_match(province, canton, catalog, threshold=85):
    def best(name, choices):
        if name in choices:
            return name, 100.0
        score, place = max((python_ratio(name, c), -i) for i, c in enumerate(choices))
        return (choices[-place], score) if score >= threshold else (None, 0.0)

    provinces = list(dict.fromkeys(p for p, _ in catalog))
    found, score = best(province, provinces)
    if found is None:
        return None, None, 0.0, 0.0, "failed_prov"
    inside, inner = best(canton, [c for p, c in catalog if p == found])
    if inside is None:
        return found, None, score, 0.0, "failed_canton"
    method = "exact" if score == 100 and inner == 100 else "fuzzy"
    return found, inside, score, inner, method


def random_names(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdeo ") for _ in range(rng.randint(1, 14))).strip() or "a"
            for _ in range(count)]


def spoil(rng, name):
    chars = list(name)
    for _ in range(rng.randint(0, 3)):
        at = rng.randrange(len(chars) + 1)
        if rng.random() < 0.5 and chars:
            del chars[min(at, len(chars) - 1)]
        else:
            chars.insert(at, rng.choice("abcdeo "))
    return " ".join("".join(chars).split())


def test_matching_against_brute_force(spark):
    rng = random.Random(3)
    names = random_names(1, 12)
    catalog = list(dict.fromkeys(
        (" ".join(rng.choice(names).split()), " ".join(c.split())) for c in random_names(2, 80)
    ))
    frame = spark.createDataFrame(
        [(p, c, i) for i, (p, c) in enumerate(catalog)],
        "province_norm string, canton_norm string, ordinal int",
    )
    rows = []
    for _ in range(400):
        province, canton = rng.choice(catalog)
        rows.append((spoil(rng, province), spoil(rng, canton)))
    rows += [("", "a"), (None, None), ("zzzz", "zzzz")]
    df = spark.createDataFrame(rows, "province string, canton string")
    for threshold in (85, 60):
        for r in territory.match_territory(df, frame, threshold).collect():
            wanted = python_match(r["province"] or "", r["canton"] or "", catalog, threshold)
            got = (r["province_norm"], r["canton_norm"], r["score_province"], r["score_canton"],
                   r["match_method"])
            assert got[:2] == wanted[:2] and got[4] == wanted[4], (r, wanted)
            assert math.isclose(got[2], wanted[2]) and math.isclose(got[3], wanted[3])


def test_matching_of_repetitive_names(spark):
    """Names of one dominant letter, whose rarest pairs repeat; and a threshold of single ones."""
    rng = random.Random(9)
    choices = ["a" * n for n in range(1, 30)] + ["".join(rng.choice("aaab") for _ in range(20))
                                                 for _ in range(60)]
    choices = list(dict.fromkeys(choices))
    names = [spoil(rng, rng.choice(choices)) for _ in range(200)] + ["ab" * 10, "a" * 31, "b"]
    names = list(dict.fromkeys(" ".join(n.lower().split()) for n in names))
    frame = spark.createDataFrame([(c, i) for i, c in enumerate(choices)], "name string, ordinal int")
    texts = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    for threshold in (90, 85, 67, 66, 50):
        found = {r["name"]: r for r in territory.best_match(texts, frame, (), threshold).collect()}
        for name in names:
            scores = [python_ratio(name, c) for c in choices]
            best = max(scores)
            if best >= threshold:
                assert found[name]["choice"] == choices[scores.index(best)], (threshold, name)
                assert math.isclose(found[name]["score"], best)
            else:
                assert name not in found


def test_equal_names_are_never_scored(spark):
    """The plan's string comparison gets no row whose name is a choice."""
    frame = spark.createDataFrame([("quito", 0), ("loja", 1)], "name string, ordinal int")
    texts = spark.createDataFrame([("quito",), ("loja",), ("quit",)], "name string")
    found = territory.best_match(texts, frame)
    scored = [r for r in found.collect() if r["score"] < 100]
    assert [r["name"] for r in scored] == ["quit"]
    alone = territory.best_match(texts.where("name <> 'quit'"), frame)
    assert {r["score"] for r in alone.collect()} == {100.0}


def test_matching_without_catalogue(spark):
    df = spark.createDataFrame([("a", "b")], "province string, canton string")
    row = territory.match_territory(df, None).first()
    assert (row["province_norm"], row["score_province"], row["match_method"]) == (
        None, 0.0, "no_catalog")


# Skew ------------------------------------------------------------------------------------------


def test_repeated_keys_with_a_hot_key(spark):
    keys = ["hot"] * 3000 + [f"k{i % 2500}" for i in range(4000)] + [None, None]
    df = spark.createDataFrame(list(zip(keys, range(len(keys)))), "k string, row_num int")
    found = skew.rows_of_repeated_keys(df, ["k"], F.col("row_num")).collect()
    counts = Counter(k for k in keys if k is not None)
    assert len(found) == sum(n for n in counts.values() if n > 1)
    assert all(r["key_rows"] == counts[r["k"]] for r in found)
    assert len({r["row_num"] for r in found}) == len(found)


def test_repeated_keys_beyond_a_broadcast(spark, monkeypatch):
    """A bit map lets rows of unique keys stay where they are, and loses none of the others."""
    keys = [f"u{i}" for i in range(3000)] + ["hot"] * 900 + [f"d{i % 50}" for i in range(100)]
    df = spark.createDataFrame(list(zip(keys, range(len(keys)))), "k string, row_num int")
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    found = skew.rows_of_repeated_keys(df, ["k"], F.col("row_num")).collect()
    assert sorted(r["row_num"] for r in found) == list(range(3000, 4000))
    hashed = df.withColumn("_hash", F.xxhash64("k"))
    often = hashed.where("row_num >= 3000").select("_hash").distinct()
    passed = skew._in_map(hashed, often).collect()
    assert {r["row_num"] for r in passed} >= set(range(3000, 4000)) and len(passed) < 1100
    assert set(passed[0].asDict()) == {"k", "row_num", "_hash"}


def test_null_safe_lookup(spark, monkeypatch):
    """Half of all keys are NULL, in one part or in both."""
    rng = random.Random(2)
    parts = ["hot", "a", "b", None, None, None]
    rows = [(rng.choice(parts), rng.choice(parts), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, j string, v int")
    pairs = sorted({r[:2] for r in rows}, key=str)[::2]
    lookup = spark.createDataFrame([(*p, i) for i, p in enumerate(pairs)], "k string, j string, w int")
    due = {"left": [], "inner": []}
    for k, j, v in rows:
        w = pairs.index((k, j)) if (k, j) in pairs else None
        due["left"].append((k, j, v, w))
        if w is not None:
            due["inner"].append((k, j, v, w))
    for limit, skewed in ((1 << 20, True), (-1, True), (-1, False)):
        monkeypatch.setattr(skew, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(skew, "HOT_ROWS", 30)
        for how in due:
            found = skew.lookup_join(df, lookup, ["k", "j"], how, skewed=skewed, null_safe=True)
            assert found.columns == ["k", "j", "v", "w"]
            got = sorted(map(tuple, found.collect()), key=str)
            assert got == sorted(due[how], key=str)


def test_equal_rows_of_a_hot_key_spread(spark, monkeypatch):
    """Rows that are equal in every column still go to several salts."""
    rows = spark.range(0, 4000, 1, 8).select(F.lit(None).cast("string").alias("k"))
    lookup = spark.createDataFrame([(None, 1)], "k string, w int")
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    assert rows.select(skew._spread(rows).alias("s")).distinct().count() > 3
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    found = skew.lookup_join(rows, lookup, ["k"], null_safe=True)
    assert found.where("w = 1").count() == 4000


def test_nested_values_are_measured(spark):
    big = spark.createDataFrame([(1, ["x" * 1000] * 5)], "k int, v array<string>")
    size = big.select(skew.row_bytes(big)).first()[0]
    assert size > 5000


def test_lookup_join_salted_equals_broadcast(spark, monkeypatch):
    keys = ["hot" if i % 3 else f"k{i % 40}" for i in range(600)] + [None] * 300
    rows = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")
    lookup = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, w int")
    for how in ("left", "inner"):
        small = rows_of(skew.lookup_join(rows, lookup, ["k"], how).select("k", "v", "w"))
        with monkeypatch.context() as patch:
            patch.setattr(skew, "BROADCAST_BYTES", -1)
            patch.setattr(skew, "HOT_ROWS", 100)
            large = skew.lookup_join(rows, lookup, ["k"], how).select("k", "v", "w")
            assert rows_of(large) == small
            plain = skew.lookup_join(rows, lookup, ["k"], how, skewed=False)
            assert rows_of(plain.select("k", "v", "w")) == small
    # The rows of the hot key and those without a key end up in more than one partition.
    monkeypatch.setattr(skew, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(skew, "HOT_ROWS", 100)
    monkeypatch.setattr(skew, "SALTS", 16)
    old = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled",
                                          "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = skew.lookup_join(rows, lookup, ["k"]).groupBy(
            "k", F.spark_partition_id().alias("p")).count().groupBy("k").count()
        spread = {r["k"]: r["count"] for r in placed.collect()}
        assert spread["hot"] > 1 and spread[None] > 1 and spread["k3"] == 1
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


# History ---------------------------------------------------------------------------------------


def python_history(files):
    """Load the files one by one, as (time, file, [(key, hash)]) lists."""
    versions, current = [], {}
    for ts, name, rows in files:
        for key, value in {k: h for k, h in rows}.items():
            old = current.get(key)
            if old and old["hash"] == value:
                old.update(last=ts, file=name)
                continue
            if old:
                old.update(last=ts, file=name, current=False)
            current[key] = dict(key=key, hash=value, first=ts, last=ts, file=name, current=True)
            versions.append(current[key])
    return sorted(
        ((v["key"], v["hash"], v["first"], v["last"], v["file"], v["current"]) for v in versions),
        key=str,
    )


COLUMNS = ["natural_key", "row_hash", "first_seen_at", "last_seen_at", "last_file_id",
           "is_current"]


def test_history_three_ways(spark):
    rng = random.Random(5)
    files = []
    for n in range(5):
        rows = [(f"k{rng.randrange(30)}", f"h{rng.randrange(3)}") for _ in range(40)]
        files.append((T0 + dt.timedelta(days=n), f"f{n}", rows))
    wanted = python_history(files)
    schema = ("file_id string, run_ts timestamp_ntz, natural_key string, row_hash string, "
              "row_num int")
    frame = spark.createDataFrame(
        [(f, ts, k, h, i) for ts, f, rows in files for i, (k, h) in enumerate(rows)], schema
    )
    assert rows_of(history.replay(frame, (), ["row_num"]).select(COLUMNS)) == wanted

    state = history.replay(frame.where("false"), (), ["row_num"])
    closed, counts = [], {}
    for ts, name, _ in files:
        last = dedup.keep_last(frame.where(F.col("file_id") == name), ["natural_key"], ["row_num"])
        merged = history.merge(
            state, last, (), F.lit(name), F.lit(ts).cast("timestamp_ntz")
        ).collect()
        counts[name] = Counter(r["change"] for r in merged)
        closed += [tuple(r[c] for c in COLUMNS) for r in merged if not r["is_current"]]
        state = spark.createDataFrame(
            [r for r in merged if r["is_current"]],
            "offer_id string, natural_key string, row_hash string, first_seen_at timestamp_ntz, "
            "last_seen_at timestamp_ntz, last_file_id string, is_current boolean, change string",
        ).drop("change")
    assert sorted(closed + rows_of(state.select(COLUMNS)), key=str) == wanted
    for r in history.run_counts(frame, ["row_num"]).collect():
        assert (r["ingest_new"], r["ingest_updated"], r["ingest_unchanged"]) == tuple(
            counts[r["file_id"]][c] for c in ("new", "updated", "unchanged")
        )


# Quality ---------------------------------------------------------------------------------------


def checked(spark):
    rows = [
        ("f", "a", 1, "h1", "on", "P", "X", "asia", "c1"),
        ("f", "a", 2, "h2", "off", "P", "X", "asia", "c1"),
        ("f", "a", 3, "h3", None, "P", "X", "asia", "c9"),
        ("f", "b", 4, "h4", "on", None, "X", None, "c1"),
        ("f", "c", 5, "h5", "on", "P", None, "asia", ""),
        ("f", "d", 6, "h6", "on", "", "X", "asia", "c1"),
        ("g", "a", 1, "h1", "on", "P", "X", "asia", "c1"),
    ]
    return spark.createDataFrame(
        rows,
        "file_id string, natural_key string, row_num bigint, row_hash string, status_norm string, "
        "provider string, program string, province_norm string, canton_norm string",
    ).withColumns({"province": F.lit("Asia"), "canton": F.lit(None).cast("string")})


def test_quality_metrics_and_issues(spark):
    rows = checked(spark)
    catalog = spark.createDataFrame(
        [("asia", "c1", 0)], "province_norm string, canton_norm string, ordinal int"
    )
    found = {(r["file_id"], r["metric"]): r["value"]
             for r in quality.metrics(rows, catalog).collect()}
    assert {k[1]: v for k, v in found.items() if k[0] == "f"} == {
        "duplicates_in_file": 3, "invalid_territory": 2, "invalid_territory_pair": 1,
        "conflicting_estado": 1, "missing_NOMBRE_IES": 1, "missing_NOMBRE_CARRERA": 1,
    }
    assert all(v == 0 for k, v in found.items() if k[0] == "g")
    issues = quality.issues(rows, catalog)
    assert Counter(r["issue_type"] for r in issues.collect()) == {
        "duplicate_natural_key": 3, "missing_territory_norm": 2, "invalid_territory_pair": 1,
        "conflicting_estado": 1, "missing_nombre_ies": 1, "missing_nombre_carrera": 1,
    }
    details = {r["issue_type"]: r["detail"] for r in issues.collect()}
    assert details["conflicting_estado"] == '{"states":["on","off"]}'
    assert details["missing_territory_norm"] == (
        '{"provincia_original":"Asia","canton_original":null}')
    without = quality.metrics(rows, None).where("metric = 'invalid_territory_pair'").collect()
    assert all(r["value"] == 0 for r in without)


def test_issue_ids_are_distinct_and_stable(spark):
    log = quality.issue_log(quality.issues(checked(spark), None), F.lit("run"), F.lit(T0))
    first, again = ({r["issue_id"] for r in log.collect()} for _ in range(2))
    assert first == again and len(first) == log.count()


# Marts -----------------------------------------------------------------------------------------


def test_diversity(spark):
    groups = {"x": "aabb", "y": "aaa", "z": [None], "w": ["a", None]}
    rows = [(g, c) for g, cats in groups.items() for c in cats] + [(None, "a")]
    df = spark.createDataFrame(rows, "g string, c string")
    found = {r["g"]: (round(r["hhi"], 9), round(r["entropy"], 9))
             for r in diversity.diversity(df, "g", "c").collect()}
    assert found == {"x": (0.5, 1.0), "y": (1.0, 0.0), "z": (0.0, 0.0), "w": (1.0, 0.0)}


def offers(spark):
    columns = ("provider", "program", "field", "level", "modality", "province", "canton",
               "status", "provider_type", "funding_type")
    rows = [
        ("p1", "a", "f1", None, "m", "x", "c1", "on", "t", "u"),
        ("p1", "a", "f1", None, "m", "x", "c2", None, "t", "u"),
        (None, "a", "f2", "l", "m", "y", "c1", "on", "t", None),
        ("p2", "a", None, "l", "m", None, "c1", "off", "s", "u"),
    ]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def test_kpis_count_null_combinations(spark):
    assert tuple(marts.kpis(offers(spark)).first()) == (4, 2, 3, 2, 2)


def test_null_groups(spark):
    df = offers(spark)
    assert rows_of(marts.value_counts(df, "status")) == [("off", 1), ("on", 2)]
    assert rows_of(marts.coverage(df)) == [("x", 2, 1), ("y", 1, 1)]
    assert rows_of(marts.provider_profile(df)) == [("p1", 2, 1, 0), ("p2", 1, 0, 1)]


def test_facets(spark):
    df = offers(spark)
    options = rows_of(filters.facet_options(df, ["canton", "funding_type"], ["y"]))
    assert options == [("canton", "c1"), ("funding_type", "u")]
    chosen = filters.Filters({"province": ["x"], "status": [], "canton": ["c2"]})
    assert filters.apply_filters(df, chosen).count() == 1


def test_day_range_is_half_open(spark):
    times = [T0 - dt.timedelta(seconds=1), T0, T0 + dt.timedelta(hours=47),
             T0 + dt.timedelta(days=2), None]
    df = spark.createDataFrame([(t,) for t in times], "ingested_at timestamp")
    days = (T0.date(), T0.date() + dt.timedelta(days=1))
    assert filters.apply_filters(df, filters.Filters(days=days)).count() == 2


def test_summary_of_nothing_and_something(spark):
    df = offers(spark)
    text = summary.dataset_summary(df, None, None).first()["summary"].split("\n")
    assert text[0] == "Dataset filtered summary" and text[6].endswith(": n/a")
    assert text[7] == "- Offer status distribution (top): on: 2, off: 1"
    empty = summary.dataset_summary(df.where("false"), "a", "b").first()
    assert empty["offers"] == 0 and empty["top_provider"] == "n/a"


def test_dedup_keeps_null_keys(spark):
    df = spark.createDataFrame(
        [(None, 1, "a"), (None, 2, "b"), ("k", 3, "c"), ("k", 4, "d")], "k string, n int, v string"
    )
    assert rows_of(dedup.keep_first(df, ["k"], ["n"])) == [("k", 3, "c"), (None, 1, "a")]
    assert rows_of(dedup.keep_last(df, ["k"], ["n"])) == [("k", 4, "d"), (None, 2, "b")]


# Ledger and constraints ------------------------------------------------------------------------


def test_ledger_states(spark):
    events = spark.createDataFrame(
        [("f", 0, T0, "running", None, "c"), ("f", 2, T0 + dt.timedelta(1), "success", "n", None),
         ("f", 3, T0 + dt.timedelta(2), None, "skipped again", None),
         ("g", 0, T0, "running", None, "d"), ("g", 2, T0, "failed", "boom", None)],
        "file_id string, event_seq int, event_at timestamp, status string, notes string, "
        "checksum string",
    )
    state = ledger.current_state(events)
    assert rows_of(state) == [("f", "success", "skipped again", "c"),
                              ("g", "failed", "boom", "d")]
    files = spark.createDataFrame([("1", "c"), ("2", "d"), ("3", "e")], "path string, checksum string")
    assert {r["path"] for r in ledger.pending(files, state).collect()} == {"2", "3"}
    assert rows_of(ledger.already_loaded(files, state)) == [("c", "1", "f")]


def test_constraint_audit(spark):
    tables = {
        "files": spark.createDataFrame(
            [("f", "n", "c", "success"), ("g", None, "c", "odd"), ("h", "n", None, None)],
            "file_id string, file_name string, checksum string, status string"),
        "step": spark.createDataFrame([("f", "s"), ("x", "s"), ("x", None), (None, "s")],
                                      "file_id string, step_name string"),
    }
    rules = [r for r in constraints.WAREHOUSE_RULES
             if r.table in tables and getattr(r, "target", "files") in tables]
    found = defaultdict(int)
    for r in constraints.audit(tables, rules).collect():
        found[r["table_name"], r["rule"]] = r["violations"]
    assert found == {
        ("files", "unique(checksum)"): 1, ("files", "domain(status)"): 1,
        ("files", "not_null(file_name)"): 1, ("files", "not_null(checksum)"): 1,
        ("step", "not_null(step_name)"): 1, ("step", "reference(file_id->files.file_id)"): 2,
    }
