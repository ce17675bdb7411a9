"""The four extracts from files to published bundles, against plain Python over the same rows."""

import dataclasses
import random
from collections import Counter, defaultdict
from itertools import product
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from yearwheel.__main__ import main
from yearwheel.operators import checks
from yearwheel.operators.staging import Staging
from yearwheel.plans import Control, extract_specs, input_checks, publish, purposes_unused, run_all, survey_extract
from yearwheel.sources import SurveyTables, column_mismatch, read_bundle

LABELS = {"YEMar": 1, "YEJun": 2, "YESep": 3, "YEDec": 4}
PLACES = ["North", "South", "Other"]
TYPES = ["Resorts, Lodges", "Employer provided accommodation"]
PURPOSES = {"Holiday": "Holiday", "Visiting Relatives": "Friends", "Visiting friends": "Friends", "None": "Other"}
ACTIVITY_GROUPS = {"Fishing": "Outdoor", "Walk In City": "Outdoor", "Business": "Work"}


def survey():
    """Rows of the four fact tables: quarters 2000 Q2 to 2002 Q1, with blanks and spellings to clean."""
    rng = random.Random(5)
    trips, stays, spend, activities = [], [], [], []
    for i in range(160):
        quarter = 1 + i % 8
        year, qtr = 2000 + quarter // 4, quarter % 4 + 1
        overnight = rng.random() < 0.5
        weight = lambda: rng.choice([None, 1, 2, 2.5])
        trips.append(
            {
                "TripIDNumber": i,
                "TripType": "Overnight Trip" if overnight else "Day Trip",
                "TripYear": year,
                "TripQtr": qtr,
                "DestinationRTO": rng.choice(["North", "South", "Other   "]),
                "POV": rng.choice(["Holiday", "Visiting relatives", "Visiting friends", None]),
                "RespondentWeight": weight(),
                "SmoothedTripWeight": weight(),
                "ExpenditureWeight": weight(),
                "ImputedSpendAccom": rng.choice([None, 10, 20.25]) if overnight else None,
                "ImputedSpendTrnsport": rng.choice([None, 5, 7.5]),
                "Unused": "x",
            }
        )
        for _ in range(rng.randrange(3)):
            kind = rng.choice(["Resorts, Lodges", "Employer provided accomodation"])
            nights = rng.choice([None, 0, 1, 14.5, 15, 40, 200])
            stays.append({"TripID": i, "AccommodationType": kind, "NoNights": nights})
        for kind in ("Alcohol", "Food And Alcohol", "Gifts", "Other   "):
            spend.append({"TripID": i, "SpendType": kind, "ImputedSpendAmt": rng.choice([0, 12.25, 30])})
        for _ in range(rng.randrange(3)):
            label = rng.choice(["Fishing", "Walk In City", "Business   ", "Unclassified"])
            activities.append({"TripID": i, "Activities": label, "AnswerNumber": 1, "LegNumber": 1})
    spend.append({"TripID": None, "SpendType": "Gifts", "ImputedSpendAmt": 99})
    return trips, stays, spend, activities


def write_csv(path, records):
    def cell(v):
        return "NA" if v is None else f'"{v}"' if isinstance(v, str) else str(v)

    lines = [",".join(records[0])] + [",".join(cell(v) for v in r.values()) for r in records]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def write_lookup(path, members):
    lines = ["Code,Description,SortOrder"] + [f'{i},"{m}",{i}' for i, m in enumerate(members, 1)]
    path.write_bytes("\r\n".join(lines).encode() + b"\r\n")
    return str(path)


BANDS = ["0 nights", "1 nights", "15 nights to less than one month", "One month to less than two months", "All"]
UNCODED = {14.5: "Error - more than one year", 200: "Six months to less than one year"}


@pytest.fixture(scope="module")
def records():
    return survey()


@pytest.fixture(scope="module")
def survey_paths(records, tmp_path_factory):
    folder = tmp_path_factory.mktemp("survey")
    header = 'c,d,g,"g\n(1)",b,bd,g,"g\n(2)"'
    purposes = [header] + [f"1,{p},P,wrong,B,B,P,{g}" for p, g in PURPOSES.items()]
    (folder / "purposes.csv").write_bytes(("\r\n".join(purposes) + "\r\n").encode())
    (folder / "classes.csv").write_text(
        "pos,Activity_Group,Activity\n1,Outdoor,Fishing\n2,NA,Walk in City\n3,Work,Business\n"
    )
    facts = zip(("trips", "stays", "spend", "activities"), records, strict=True)
    return {n: write_csv(folder / f"{n}.csv", r) for n, r in facts} | {
        "purposes": str(folder / "purposes.csv"),
        "classification": str(folder / "classes.csv"),
        "destinations": write_lookup(folder / "destinations.csv", [*PLACES, "All"]),
        "lengths_of_stay": write_lookup(folder / "bands.csv", BANDS),
        "accommodation_types": write_lookup(folder / "types.csv", [*TYPES, "All"]),
    }


@pytest.fixture(scope="module")
def tables(spark, survey_paths):
    return SurveyTables.read(spark, **survey_paths, number="decimal(18,2)")


def clean_place(trip):
    return trip["DestinationRTO"].strip()


def clean_purpose(trip):
    return {None: "None", "Visiting relatives": "Visiting Relatives"}.get(trip["POV"], trip["POV"])


def fact_rows(name, records):
    """(year, quarter), dimensions and measures of each fact row."""
    trips, stays, spend, activities = records
    by_id = {t["TripIDNumber"]: t for t in trips}
    when = lambda t: (t["TripYear"], t["TripQtr"])
    if name == "accommodation":
        bands = {0: BANDS[0], 1: BANDS[1], 15: BANDS[2], 40: BANDS[3]} | UNCODED
        for s in stays:
            t = by_id[s["TripID"]]
            if t["TripType"] == "Overnight Trip":
                nights, trip_weight = s["NoNights"] or 0, t["SmoothedTripWeight"] or 0
                kind = s["AccommodationType"].replace("accomodation", "accommodation")
                dims = (bands[nights], clean_place(t), kind)
                yield when(t), dims, (t["RespondentWeight"] or 0, trip_weight, nights * trip_weight, 1)
        return
    if name == "activity":
        for a in activities:
            group = ACTIVITY_GROUPS.get(a["Activities"].strip())
            if group:
                t = by_id[a["TripID"]]
                yield when(t), (group,), (t["SmoothedTripWeight"] or 0,)
        return
    for t in trips:
        dims = (clean_place(t), t["TripType"], clean_purpose(t), PURPOSES[clean_purpose(t)])
        if name == "trips":
            yield when(t), dims, (t["RespondentWeight"] or 0, t["SmoothedTripWeight"] or 0, 1)
            continue
        weight = t["ExpenditureWeight"] or 0
        own = {s["SpendType"].strip(): weight * s["ImputedSpendAmt"] for s in spend if s["TripID"] == t["TripIDNumber"]}
        own["FoodAndBeverages"] = own.pop("Food And Alcohol") - own["Alcohol"]
        own["Transport"] = weight * (t["ImputedSpendTrnsport"] or 0)
        if t["TripType"] == "Overnight Trip":
            own["Accomodation"] = weight * (t["ImputedSpendAccom"] or 0)
        for kind, amount in own.items():
            yield when(t), (*dims, kind), (amount,)


def expected_cube(name, records):
    base = defaultdict(lambda: None)
    seen = defaultdict(set)
    if name == "accommodation":
        quarters = [(t["TripYear"], t["TripQtr"]) for t in records[0] if t["TripType"] == "Overnight Trip"]
    else:
        quarters = [r[0] for r in fact_rows(name, records)]

    def year_ends(year, qtr):
        return [f"{label}{year if qtr <= last else year + 1}" for label, last in LABELS.items()]

    for year, qtr in quarters:
        for ye in year_ends(year, qtr):
            seen[ye].add(qtr)
    for (year, qtr), dims, measures in fact_rows(name, records):
        for ye in year_ends(year, qtr):
            if len(seen[ye]) == 4:
                for keep in product((True, False), repeat=1 + len(dims)):
                    key = tuple(v if k else "All" for v, k in zip((ye, *dims), keep, strict=True))
                    old = base[key] or (0,) * len(measures)
                    base[key] = tuple(a + b for a, b in zip(old, measures, strict=True))
    return dict(base)


@pytest.mark.parametrize("name", ["accommodation", "trips", "spend", "activity"])
def test_cube_equals_plain_python(name, tables, records, stage):
    spec = extract_specs("Survey")[name]
    extract = survey_extract(name, spec, tables, stage)
    n = len(spec.dims)
    got = {tuple(r)[:n]: tuple(float(v) for v in tuple(r)[n:]) for r in extract.cube.collect()}
    want = expected_cube(name, records)
    assert len(got) == extract.cube.count()
    assert got == {k: tuple(float(x) for x in v) for k, v in want.items()}


@pytest.fixture(scope="module")
def published(spark, tables, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    return run_all(spark, tables, str(out), survey="Survey", run_id="20300101-0000")


@pytest.mark.parametrize(("name", "files"), [("accommodation", 12), ("trips", 14), ("spend", 16), ("activity", 8)])
def test_bundle(name, files, spark, published, records):
    folder, spec = published[name], extract_specs("Survey")[name]
    assert folder.endswith(f"/20300101-0000/Table_{spec.table_id}")
    assert len(list(Path(folder).glob("*.csv"))) == files
    bundle = read_bundle(spark, folder)
    assert bundle.table_id == spec.table_id and column_mismatch(bundle) == []
    assert bundle.file_index.first().TableTitle == spec.title

    # decode the published codes again and compare with plain Python
    members = {d: {r.Code: r.Description for r in bundle.lookups[d].collect()} for d in spec.dims}
    n, got = len(spec.dims), {}
    for r in bundle.data.collect():
        key = tuple(members[d][c].replace(" ", "", 1) if d == spec.year_dim else members[d][c] for d, c in zip(spec.dims, r))
        got[key] = tuple(float(v) for v in tuple(r)[n:])
    want = expected_cube(name, records)
    if name == "accommodation":
        # bands without a code are lost from the data, not from its totals
        want = {k: v for k, v in want.items() if k[1] not in UNCODED.values()}
    assert got.keys() == want.keys()
    tolerance = (0.005 if name == "spend" else 0.5) + 1e-6
    for k, v in got.items():
        assert all(abs(a - b) <= tolerance for a, b in zip(v, want[k], strict=True))


def test_published_text(published):
    lookup = next(Path(published["trips"]).glob("DimenLookupTripType7579.csv/part-*"))
    assert lookup.read_text() == 'Code,Description,SortOrder\n1,"Day Trip",\n2,"Overnight Trip",\n3,"All",\n'
    pov = next(Path(published["trips"]).glob("DimenLookupPOV7579.csv/part-*")).read_text().splitlines()
    assert pov[3:5] == ['3,"Visiting friends",', '4,"Visiting Relatives",']
    tree = next(Path(published["trips"]).glob("DimenHierarchyTripType7579.csv/part-*"))
    assert sorted(tree.read_text().splitlines()) == ["3,1", "3,2", "Parent,Child"]
    index = next(Path(published["activity"]).glob("DimensionIndex.csv/part-*"))
    assert index.read_text() == (
        'DimensionCode,DimensionTitle\n"Year_Ending","Year ending"\n"Activity_Group","Activity group"\n'
    )
    file_index = next(Path(published["spend"]).glob("FileIndex.csv/part-*"))
    assert file_index.read_text() == (
        "TableID,TableCode,TableTitle,TableFileName,TableURL\n7580,TABLECODE7580,Survey: Visitor Spend,,\n"
    )


def test_control_figures(tables, records, stage):
    spec = extract_specs("Survey")["trips"]
    extract = survey_extract("trips", spec, tables, stage)
    cube = expected_cube("trips", records)
    day = cube["YEMar2002", "All", "Day Trip", "All", "All"][1]
    members = {"Year_Ending": "YEMar2002", "Trip_Type": "Day Trip"}
    total = cube["All", "All", "All", "All", "All"][1]
    controls = [Control("Total_Trips", int(day), members), Control("Total_Trips", total, how="within")]
    checks.require(extract.reconcile(controls))
    with pytest.raises(checks.CheckFailed, match="Total_Trips YEMar2002 Day Trip"):
        checks.require(extract.reconcile([Control("Total_Trips", int(day) + 1, members)]))


def test_input_checks(spark, tables, stage):
    assert input_checks("activity", tables) is None and input_checks("trips", tables) is None
    assert all(r.ok for r in input_checks("spend", tables).collect())
    second = tables.spend.where("TripID = 3 AND SpendType = 'Alcohol'")
    spoiled = dataclasses.replace(tables, spend=tables.spend.unionByName(second))
    with pytest.raises(checks.CheckFailed, match="food type: 1.0"):
        checks.require(input_checks("spend", spoiled))
    extra = tables.purposes.unionByName(spark.sql("SELECT 'Skiing' POV, 'Holiday' POV_Group"))
    more = dataclasses.replace(tables, purposes=extra)
    extract = survey_extract("trips", extract_specs("Survey")["trips"], more, stage)
    with pytest.raises(checks.CheckFailed, match="purposes without trips: 1.0"):
        checks.require(purposes_unused(more, extract))


def test_losses_are_reported(tables, records, stage, tmp_path, spark):
    spec = extract_specs("Survey")["accommodation"]
    lost = {r.member: float(r.Total_Respondents) for r in survey_extract("accommodation", spec, tables, stage).losses.collect()}
    assert set(lost) <= set(UNCODED.values()) and lost
    activity = survey_extract("activity", extract_specs("Survey")["activity"], tables, Staging(spark, str(tmp_path / "a")))
    trips = {t["TripIDNumber"]: t for t in records[0]}
    want = sum(trips[a["TripID"]]["SmoothedTripWeight"] or 0 for a in records[3] if a["Activities"] == "Unclassified")
    (row,) = activity.losses.collect()
    assert (row.dimension, row.member, float(row.Total_Activities)) == ("Activities", "Unclassified", float(want))
    with pytest.raises(checks.CheckFailed, match="without a group or code"):
        run_all(spark, tables, str(tmp_path / "out"), survey="S", names=["activity"], refuse_losses=True)


def test_controls_of_inputs(tables, records, stage):
    extract = survey_extract("activity", extract_specs("Survey")["activity"], tables, stage)
    trips = {t["TripIDNumber"]: t for t in records[0]}
    quarter = {a["TripID"] for a in records[3] if (trips[a["TripID"]]["TripYear"], trips[a["TripID"]]["TripQtr"]) == (2000, 3)}
    weight = sum(trips[i]["SmoothedTripWeight"] or 0 for i in quarter)
    where = {"TripYear": 2000, "TripQtr": 3}
    good = [
        Control("Raw_Count", len(records[3]), of="quarterly"),
        Control("SmoothedTripWeight", weight, where, "within", "trips_with_details"),
    ]
    checks.require(extract.reconcile(good))
    assert "Raw_Count" in extract.base.columns and "Raw_Count" not in extract.data.columns
    with pytest.raises(checks.CheckFailed, match="Raw_Count of quarterly"):
        checks.require(extract.reconcile([Control("Raw_Count", 1, of="quarterly")]))


@pytest.mark.parametrize("name", ["accommodation", "trips"])
def test_doubled_codes_stop_an_extract(name, tables, stage):
    twice = dataclasses.replace(tables, destinations=tables.destinations.unionByName(tables.destinations))
    with pytest.raises(checks.CheckFailed, match="several codes"):
        survey_extract(name, extract_specs("Survey")[name], twice, stage)


def scans(df, plan):
    """How often each fact file is scanned."""
    text = plan(df)
    return {fact: text.count(f"{fact}.csv") for fact in ("trips", "stays", "spend", "activities")}


def test_a_whole_run_scans_each_fact_table_once(spark, tables, tmp_path, plan, monkeypatch):
    """One pass serves all extracts, rules on the inputs included; all that is staged or written later reads its totals."""
    seen, written = Counter(), []
    real = Staging.__call__

    def counting(self, df, name, by=()):
        written.append(name)
        seen.update(scans(df, plan))
        return real(self, df, name, by)

    from yearwheel.plans import run

    def publishing(extract, *_):
        for df in [*extract.tables().values(), extract.losses]:
            seen.update(scans(df, plan))
        return extract.spec.table_id

    monkeypatch.setattr(Staging, "__call__", counting)
    monkeypatch.setattr(run, "publish", publishing)
    run_all(spark, tables, str(tmp_path), survey="S")
    assert seen == {"trips": 1, "stays": 1, "spend": 1, "activities": 1}
    assert written.count("quarters") == 1


@pytest.mark.parametrize("name", ["accommodation", "trips", "spend", "activity"])
def test_shared_pass_equals_own_pass(name, spark, tables, records, tmp_path, rows):
    from yearwheel.plans.facts import fact_pass

    together = fact_pass(tables, ["accommodation", "trips", "spend", "activity"], Staging(spark, str(tmp_path / "all")), strict=True)
    alone = fact_pass(tables, [name], Staging(spark, str(tmp_path / "one")))
    columns = sorted(alone.quarterly[name].columns)
    assert rows(together.quarterly[name], *columns) == rows(alone.quarterly[name], *columns)
    assert rows(together.spend_rules, "control", "ok") == rows(input_checks("spend", tables), "control", "ok")


def test_rules_of_the_pass_see_spend_of_unknown_trips(spark, tables, tmp_path):
    from yearwheel.plans.facts import fact_pass

    orphan = tables.spend.unionByName(spark.sql("SELECT 99999L TripID, 'Alcohol' SpendType, CAST(1 AS DECIMAL(18,2)) ImputedSpendAmt").select(tables.spend.columns))
    more = dataclasses.replace(tables, spend=orphan)
    facts = fact_pass(more, ["spend", "activity"], Staging(spark, str(tmp_path)), strict=True)
    with pytest.raises(checks.CheckFailed, match="food type: 1.0"):
        checks.require(facts.spend_rules)
    assert facts.quarterly["spend"].where("Destination_RTO IS NULL").count() == 0


def test_a_year_counts_whose_quarters_have_no_stays(spark, tables, records, tmp_path):
    """Overnight trips of a quarter without any stay still complete its years, from the one scan of the trips."""
    quarter = [t["TripIDNumber"] for t in records[0] if (t["TripYear"], t["TripQtr"]) == (2001, 2)]
    fewer = dataclasses.replace(tables, stays=tables.stays.where(~F.col("TripID").isin(quarter)))
    spec = extract_specs("Survey")["accommodation"]
    extract = survey_extract("accommodation", spec, fewer, Staging(spark, str(tmp_path)))
    stays = [s for s in records[1] if s["TripID"] not in quarter]
    want = expected_cube("accommodation", (records[0], stays, records[2], records[3]))
    years = {r[0] for r in extract.base.select("Year_Ending").distinct().collect()}
    assert years == {k[0] for k in want} - {"All"}
    assert "YEDec2001" in years


def test_dependent_dimension_is_summed_only_where_it_holds(spark, tables, stage, tmp_path):
    spec = extract_specs("Survey")["trips"]
    assert survey_extract("trips", spec, tables, stage).follows == (("POV", "POV_Group"),)
    both = tables.purposes.unionByName(spark.sql("SELECT 'Holiday' POV, 'Work' POV_Group"))
    doubled = survey_extract("trips", spec, dataclasses.replace(tables, purposes=both), Staging(spark, str(tmp_path)))
    assert doubled.follows == ()
    row = doubled.cube.where("Year_Ending = 'All' AND Destination_RTO = 'All' AND Trip_Type = 'All' AND POV = 'Holiday'")
    trips = {r.POV_Group: r.Total_Respondents for r in row.collect()}
    assert trips["All"] == 2 * trips["Holiday"] == 2 * trips["Work"]


def test_repeated_codes_are_refused(tables, stage):
    twice = dataclasses.replace(tables, destinations=tables.destinations.unionByName(tables.destinations))
    with pytest.raises(checks.CheckFailed, match="members of Destination_RTO with several codes"):
        survey_extract("trips", extract_specs("Survey")["trips"], twice, stage)


def test_command_line(spark, survey_paths, tmp_path):
    options = [a for k, v in survey_paths.items() for a in (f"--{k.replace('_', '-')}", v)]
    controls = tmp_path / "controls.json"
    controls.write_text('{"activity": [{"measure": "Raw_Count", "expected": 0, "how": "within", "of": "base"}]}')
    arguments = [*options, "--out", str(tmp_path), "--survey", "S", "--run-id", "r", "--extract", "activity"]
    with pytest.raises(checks.CheckFailed, match="Raw_Count"):
        main([*arguments, "--controls", str(controls)])
    folders = main([*arguments, "--data-parts", "1", "--read-back"])
    assert len(list(Path(folders["activity"]).glob("Data7581.csv/part-*"))) == 1
    assert folders == {"activity": f"{tmp_path}/r/Table_7581"}
    assert read_bundle(spark, folders["activity"]).file_index.first().TableTitle == "S: Activities"


def test_a_run_is_not_overwritten(spark, tables, published, stage):
    spec = extract_specs("Survey")["activity"]
    out = published["activity"].rsplit("/", 2)[0]
    with pytest.raises(Exception, match="already exists"):
        publish(survey_extract("activity", spec, tables, stage), out, "20300101-0000")


def test_unknown_destination_fails_where_the_extract_forbids_it(spark, tables, stage):
    fewer = dataclasses.replace(tables, destinations=tables.destinations.where("Description <> 'South'"))
    extract = survey_extract("trips", extract_specs("Survey")["trips"], fewer, stage)
    with pytest.raises(Exception, match="no code for Destination_RTO South"):
        extract.data.collect()


def test_members_that_share_a_code_stay_rows_of_their_own(tables, stage, rows):
    one = F.when(F.col("Description") == "All", F.col("Code")).otherwise(F.lit(1).cast("int"))
    shared = dataclasses.replace(tables, destinations=tables.destinations.withColumn("Code", one))
    extract = survey_extract("trips", extract_specs("Survey")["trips"], shared, stage)
    assert extract.shared_codes
    assert extract.data.count() == extract.cube.count()


def test_missing_spend_is_refused(tables, stage):
    blank = F.when((F.col("TripID") == 3) & (F.col("SpendType") == "Alcohol"), None).otherwise(F.col("ImputedSpendAmt"))
    spoiled = dataclasses.replace(tables, spend=tables.spend.withColumn("ImputedSpendAmt", blank))
    extract = survey_extract("spend", extract_specs("Survey")["spend"], spoiled, stage)
    with pytest.raises(Exception, match="missing values in Expenditure at YE"):
        extract.data.collect()


def test_facts_are_read_once(tables, stage, plan):
    """What is computed after staging never goes back to the fact files."""
    spec = extract_specs("Survey")["spend"]
    extract = survey_extract("spend", spec, tables, stage)
    for name, df in extract.tables().items():
        assert "spend.csv" not in plan(df) and "trips.csv" not in plan(df), name
