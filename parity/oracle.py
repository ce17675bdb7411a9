"""SQL for each registered query, for DuckDB on the same parquet tables.

Each statement is assembled from the named views it mentions; a view is plain SQL text.
"""

from __future__ import annotations

import re

from parity import queries as q
from parity import tables as t


def _values(name: str, columns: list[str], rows: list[tuple]) -> str:
    def literal(v) -> str:
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS {name}({', '.join(columns)})"


def _label(prefix: str, last: int) -> str:
    carried = f"CASE WHEN TripQtr <= {last} THEN 0 ELSE 1 END"
    return f"'{prefix}' || CAST(TripYear + {carried} AS VARCHAR)"


LABELS = {"YEMar": 1, "YEJun": 2, "YESep": 3, "YEDec": 4}
MONTH = 365.25 / 12


def _band(x: str) -> str:
    number = f"CASE WHEN {x} = floor({x}) THEN CAST(CAST({x} AS BIGINT) AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"
    return f"""CASE WHEN {x} <= 14 THEN {number} || ' nights'
        WHEN {x} >= 15 AND {x} < {MONTH} THEN '15 nights to less than one month'
        WHEN {x} >= {MONTH} AND {x} < {2 * MONTH} THEN 'One month to less than two months'
        WHEN {x} >= {2 * MONTH} AND {x} < {3 * MONTH} THEN 'Two months to less than three months'
        WHEN {x} >= {3 * MONTH} AND {x} < {6 * MONTH} THEN 'Three months to less than six months'
        WHEN {x} >= {6 * MONTH} AND {x} < {12 * MONTH} THEN 'Six months to less than one year'
        ELSE 'Error - more than one year' END"""


def _stacked(fact: str) -> str:
    return " UNION ALL ".join(f"SELECT {_label(p, k)} AS YE, {fact}.* FROM {fact}" for p, k in LABELS.items())


def _complete(stacked: str) -> str:
    return (
        f"SELECT YE FROM (SELECT DISTINCT YE, TripQtr FROM {stacked}) GROUP BY YE HAVING count(*) = 4"
    )


def _base(name: str, complete: str) -> str:
    spec = q.SPECS[name]
    dims = ", ".join(spec.detail_dims)
    sums = ", ".join(f"sum({m}) AS {m}" for m in spec.measure_codes)
    return f"""SELECT YE AS Year_Ending, {dims}, {sums} FROM v_stacked_{name}
        WHERE YE IN (SELECT YE FROM {complete}) GROUP BY YE, {dims}"""


def _cube(name: str) -> str:
    spec = q.SPECS[name]
    members = ", ".join(f"CASE WHEN GROUPING(b.{c}) = 1 THEN 'All' ELSE b.{c} END AS {c}" for c in spec.dims)
    keys = ", ".join(f"b.{c}" for c in spec.dims)
    sums = ", ".join(f"sum(b.{m}) AS {m}" for m in spec.measure_codes)
    return f"SELECT {members}, {sums}, GROUPING({keys}) AS level FROM v_base_{name} b GROUP BY CUBE({keys})"


def _text(x: str, decimals: int) -> str:
    if decimals == 0:
        return f"CAST(CAST(round_even(CAST({x} AS DOUBLE), 0) AS DECIMAL(38,0)) AS VARCHAR)"
    return f"printf('%.{decimals}f', CAST({x} AS DOUBLE))"


def _lookup(name: str, column: str) -> str:
    """Generated lookup of a column of a base."""
    return f"""SELECT CAST(row_number() OVER (ORDER BY m = 'All', lower(m), m) AS INT) AS Code, m AS Description
        FROM (SELECT DISTINCT {column} AS m FROM {name} UNION ALL SELECT 'All')"""


def _year_lookup(source: str, column: str) -> str:
    return f"""SELECT YE, CAST(row_number() OVER (ORDER BY YE = 'All', y, qtr) AS INT) AS Code,
        CASE WHEN YE = 'All' THEN 'All' ELSE left(YE, 5) || ' ' || right(YE, 4) END AS Description
        FROM (SELECT YE, CASE WHEN YE <> 'All' THEN CAST(right(YE, 4) AS INT) END AS y,
                     CASE left(YE, 5) WHEN 'YEMar' THEN 1 WHEN 'YEJun' THEN 2 WHEN 'YESep' THEN 3 ELSE 4 END AS qtr
              FROM (SELECT DISTINCT {column} AS YE FROM {source} UNION ALL SELECT 'All'))"""


VIEWS = {
    "v_purposes": _values("p", ["POV", "POV_Group"], t.PURPOSES),
    "v_partial_purposes": _values("p", ["POV", "POV_Group"], t.PARTIAL_PURPOSES),
    "v_types": _values("a", ["Code", "Description"], [(i, m) for i, m in enumerate(t.ACCOMMODATION_TYPES, 1)]),
    "v_bands": _values("b", ["Code", "Description"], [(i, m) for i, m in enumerate(t.BANDS, 1)]),
    "v_destinations": """SELECT n_nationkey + 1 AS Code, n_name AS Description FROM nation
        UNION ALL SELECT max(n_nationkey) + 2, 'All' FROM nation""",
    "v_trips": """SELECT o_orderkey AS TripIDNumber, CAST(year(o_orderdate) AS INT) AS TripYear,
            CAST(quarter(o_orderdate) AS INT) AS TripQtr,
            CASE WHEN o_orderstatus = 'F' THEN 'Day Trip' ELSE 'Overnight Trip' END AS TripType,
            n_name AS DestinationRTO, nullif(o_orderpriority, '4-NOT SPECIFIED') AS POV,
            CAST(c_acctbal AS DECIMAL(18,2)) AS RespondentWeight,
            CAST(o_totalprice AS DECIMAL(18,2)) AS SmoothedTripWeight,
            CAST(day(o_orderdate) AS DECIMAL(9,0)) AS ExpenditureWeight,
            CASE WHEN o_orderstatus <> 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS ImputedSpendAccom,
            CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END AS ImputedSpendTrnsport
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "v_clean": """SELECT * REPLACE (coalesce(POV, 'None') AS POV, coalesce(ImputedSpendAccom, 0) AS ImputedSpendAccom,
            coalesce(ImputedSpendTrnsport, 0) AS ImputedSpendTrnsport) FROM v_trips""",
    "v_stays": f"""SELECT l_orderkey AS TripID, p_type AS AccommodationType,
            CAST(8 * (l_quantity - 1) AS DECIMAL(9,0)) AS NoNights, {_band("(8 * (l_quantity - 1))")} AS LOS_Group
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_spend": """SELECT l_orderkey AS TripID, CASE WHEN l_returnflag = 'N' THEN 'Gifts'
            WHEN l_linestatus = 'F' THEN 'Alcohol' ELSE 'Food And Alcohol' END AS SpendType,
            sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS ImputedSpendAmt
        FROM lineitem GROUP BY 1, 2""",
    "v_weighted_spend": """SELECT TripIDNumber, SpendType, ExpenditureWeight * ImputedSpendAmt AS Expenditure
        FROM v_clean JOIN v_spend ON TripIDNumber = TripID""",
    "v_wide_spend": """SELECT TripIDNumber, sum(CASE WHEN SpendType = 'Alcohol' THEN Expenditure END) AS Alcohol,
            sum(CASE WHEN SpendType = 'Food And Alcohol' THEN Expenditure END) AS FoodAndAlcohol
        FROM v_weighted_spend WHERE SpendType IN ('Alcohol', 'Food And Alcohol') GROUP BY TripIDNumber""",
    "v_long_spend": """SELECT TripIDNumber, SpendType, Expenditure FROM v_weighted_spend
            WHERE SpendType NOT IN ('Alcohol', 'Food And Alcohol')
        UNION ALL SELECT TripIDNumber, 'Alcohol', coalesce(Alcohol, 0) FROM v_wide_spend
        UNION ALL SELECT TripIDNumber, 'FoodAndBeverages', coalesce(FoodAndAlcohol, 0) - coalesce(Alcohol, 0)
            FROM v_wide_spend
        UNION ALL SELECT TripIDNumber, 'Accomodation', ExpenditureWeight * ImputedSpendAccom FROM v_clean
            WHERE TripType = 'Overnight Trip'
        UNION ALL SELECT TripIDNumber, 'Transport', ExpenditureWeight * ImputedSpendTrnsport FROM v_clean""",
    "v_activities": """SELECT l_orderkey AS TripID, p_name AS Activities
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "v_classification": "SELECT p_name AS Activity, min(p_type) AS Activity_Group FROM part GROUP BY p_name",
    "v_filled": """SELECT pos, Activity, last_value(g IGNORE NULLS) OVER (ORDER BY pos
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Activity_Group
        FROM (SELECT p_partkey AS pos, CASE WHEN p_size <= 7 THEN p_brand END AS g, p_name AS Activity
              FROM part)""",
    "v_gappy": """SELECT pos, spot, k, Activity, CASE WHEN spot IS NULL THEN g ELSE last_value(g IGNORE NULLS) OVER (
            PARTITION BY k, spot IS NULL ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS Activity_Group
        FROM (SELECT p_partkey AS pos, CASE WHEN p_partkey % 13 <> 0 THEN p_partkey END AS spot,
                     CASE WHEN p_partkey % 11 <> 0 THEN p_partkey % 3 END AS k,
                     CASE WHEN p_size <= 7 THEN p_brand END AS g, p_name AS Activity FROM part)""",
    "v_customers": "SELECT 'Customer ' || o_custkey AS member FROM orders",
    "v_rows_accommodation": """SELECT TripYear, TripQtr, LOS_Group, DestinationRTO AS Destination_RTO,
            AccommodationType AS Accommodation_Type, RespondentWeight AS Total_Visitors,
            SmoothedTripWeight AS Total_Trips, NoNights * SmoothedTripWeight AS Total_Nights,
            1 AS Total_Respondents
        FROM v_clean JOIN v_stays ON TripIDNumber = TripID WHERE TripType = 'Overnight Trip'""",
    "v_rows_trips": """SELECT TripYear, TripQtr, DestinationRTO AS Destination_RTO, TripType AS Trip_Type, POV,
            POV_Group, RespondentWeight AS Total_Visitors, SmoothedTripWeight AS Total_Trips,
            1 AS Total_Respondents
        FROM v_clean JOIN v_purposes USING (POV)""",
    "v_rows_spend": """SELECT TripYear, TripQtr, DestinationRTO AS Destination_RTO, TripType AS Trip_Type, POV,
            POV_Group, SpendType AS Spend_Type, Expenditure
        FROM v_clean JOIN v_purposes USING (POV) JOIN v_long_spend USING (TripIDNumber)""",
    "v_rows_activity": """SELECT TripYear, TripQtr, Activity_Group, SmoothedTripWeight AS Total_Activities
        FROM v_clean JOIN v_activities ON TripIDNumber = TripID JOIN v_classification ON Activities = Activity""",
    "v_overnight": "SELECT TripYear, TripQtr FROM v_trips WHERE TripType = 'Overnight Trip'",
    "v_stacked_overnight": _stacked("v_overnight"),
    "v_complete_overnight": _complete("v_stacked_overnight"),
    "v_stacked_all": _stacked("v_trips"),
    "v_complete_all": _complete("v_stacked_all"),
}
for _name in q.SPECS:
    VIEWS[f"v_stacked_{_name}"] = _stacked(f"v_rows_{_name}")
    VIEWS[f"v_complete_{_name}"] = _complete(f"v_stacked_{_name}")
    _years = "v_complete_overnight" if _name == "accommodation" else f"v_complete_{_name}"
    VIEWS[f"v_base_{_name}"] = _base(_name, _years)
    VIEWS[f"v_cube_{_name}"] = _cube(_name)
    VIEWS[f"v_years_{_name}"] = _year_lookup(f"v_base_{_name}", "Year_Ending")
    for _dim in q.SPECS[_name].detail_dims:
        VIEWS[f"v_codes_{_name}_{_dim}"] = {
            "LOS_Group": "SELECT * FROM v_bands",
            "Destination_RTO": "SELECT * FROM v_destinations",
            "Accommodation_Type": "SELECT * FROM v_types",
        }.get(_dim, _lookup(f"v_base_{_name}", _dim))
VIEWS["v_pov_lookup"] = _lookup("v_clean", "POV")
VIEWS["v_many_lookup"] = _lookup("v_customers", "member")


def _with(query: str) -> str:
    """Prefix the views a statement needs, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+", text):
            if name not in needed:
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(query)
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    return f"WITH {views}\n{query}" if needed else query


def _cube_query(name: str) -> str:
    spec = q.SPECS[name]
    sums = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in spec.measure_codes)
    return f"SELECT {', '.join(spec.dims)}, {sums} FROM v_cube_{name}"


def _encoded(name: str, measures: str) -> str:
    spec = q.SPECS[name]
    codes = ", ".join(f"k_{d}.Code AS {d}" for d in spec.dims)
    joins = f" JOIN v_years_{name} k_Year_Ending ON f.Year_Ending = k_Year_Ending.YE"
    for d in spec.detail_dims:
        # codes of the trips cube all come from the data when it is encoded on its own
        joins += f" JOIN v_codes_{name}_{d} k_{d} ON f.{d} = k_{d}.Description"
    return f"SELECT {codes}, {measures} FROM v_cube_{name} f{joins}"


def _extract_query(name: str) -> str:
    text = ", ".join(f"{_text('f.' + m.code, m.decimals)} AS {m.code}" for m in q.SPECS[name].measures)
    return _encoded(name, text)


def _encode_trips() -> str:
    return _encoded("trips", ", ".join(f"CAST(f.{m} AS DOUBLE) AS {m}" for m in q.TRIP_MEASURES))


_LABEL_COLUMNS = ", ".join(f"{_label(p, k)} AS {p}" for p, k in LABELS.items())
_QUARTERS = """SELECT DISTINCT TripYear, TripQtr,
    CAST(last_day(make_date(TripYear, TripQtr * 3, 1)) AS DATE) AS QEDate FROM v_trips"""
VIEWS["v_quarters"] = _QUARTERS
VIEWS["v_whole_years"] = """SELECT QEDate AS whole_year, TripYear, TripQtr, lagged, less9m FROM (
    SELECT *, lag(QEDate, 3) OVER (ORDER BY QEDate) AS lagged,
        CAST(last_day(QEDate - INTERVAL 9 MONTH) AS DATE) AS less9m FROM v_quarters) WHERE lagged = less9m"""

_IN_YEAR = "((TripYear = 1999 AND TripQtr = 4) OR (TripYear = 2000 AND TripQtr <= 3))"


def _control(label: str, actual: str, expected: str, tolerance: str = "= 0") -> str:
    return f"""SELECT '{label}' AS control, a AS actual, e AS expected, abs(a - e) {tolerance} AS ok
        FROM (SELECT CAST(({actual}) AS DOUBLE) AS a, CAST(({expected}) AS DOUBLE) AS e)"""


def _trip_type_control(kind: str) -> str:
    return _control(
        f"Total_Trips {q.CONTROL_YEAR} {kind}",
        f"SELECT trunc(sum(Total_Trips)) FROM v_base_trips WHERE Year_Ending = '{q.CONTROL_YEAR}' AND Trip_Type = '{kind}'",
        f"SELECT floor(sum(SmoothedTripWeight)) FROM v_clean WHERE {_IN_YEAR} AND TripType = '{kind}'",
    )


def _recoded(name: str) -> str:
    quote = lambda v: "'" + v.replace("'", "''") + "'"
    values = q.rule_inputs(name)
    given = f"[{', '.join(map(quote, values))}][CAST(o_orderkey % {len(values)} + 1 AS INT)]"
    cases = " ".join(f"WHEN {quote(old)} THEN {quote(new)}" for old, new in q.RULE_SETS[name].items())
    return f"SELECT '{name}' AS rules, CASE {given} {cases} ELSE {given} END AS value, count(*) AS n FROM orders GROUP BY 2"


def _lost(name: str, dim: str, source: str, known: str) -> str:
    sums = ", ".join(f"CAST(sum({m}) AS DOUBLE) AS {m}" for m in q.SPECS[name].measure_codes)
    return f"""SELECT '{dim}' AS dimension, {dim} AS member, {sums} FROM {source}
        WHERE {dim} NOT IN ({known}) GROUP BY {dim}"""


def _wide() -> str:
    dims = list(t.WIDE_SQL)
    members = ", ".join(f"CASE WHEN GROUPING({d}) = 1 THEN 'All' ELSE CAST({d} AS VARCHAR) END AS {d}" for d in dims)
    columns = ", ".join(f"{sql} AS {d}" for d, sql in t.WIDE_SQL.items())
    return f"""SELECT {members}, CAST(sum(v) AS DOUBLE) AS total
        FROM (SELECT {columns}, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders) GROUP BY CUBE({', '.join(dims)})"""


VIEWS["v_clean_measures"] = """SELECT POV, RespondentWeight AS Total_Visitors, SmoothedTripWeight AS Total_Trips,
    1 AS Total_Respondents FROM v_clean"""
VIEWS["v_clean_activities"] = """SELECT Activities, SmoothedTripWeight AS Total_Activities
    FROM v_clean JOIN v_activities ON TripIDNumber = TripID"""

_YEAR_2000 = "SELECT sum(SmoothedTripWeight) FROM v_clean WHERE TripYear = 2000"
_BY = "SELECT sum(x) FROM (SELECT sum(Total_Trips) AS x FROM v_base_trips WHERE Year_Ending = '{}' GROUP BY {})"

_WITH_ACTIVITY = """SELECT sum(SmoothedTripWeight) FROM v_clean
    WHERE TripYear = 1998 AND TripQtr = 3 AND TripIDNumber IN (SELECT TripID FROM v_activities)"""

STATEMENTS = {
    "scan_trips": """SELECT TripIDNumber, TripType AS Trip_Type, DestinationRTO AS Destination_RTO,
        CAST(SmoothedTripWeight AS DOUBLE) AS Total_Trips FROM v_trips""",
    "lookup_prebuilt": """SELECT CAST(Code AS INT) AS Code, Description, count(*) AS n_stays
        FROM v_stays JOIN v_types ON AccommodationType = Description GROUP BY ALL""",
    "purpose_concordance": """SELECT p.POV, p.POV_Group, count(c.TripIDNumber) AS n_trips
        FROM v_purposes p LEFT JOIN v_clean c ON p.POV = c.POV GROUP BY ALL""",
    "purpose_group": """SELECT POV_Group, count(*) AS n_trips, CAST(sum(SmoothedTripWeight) AS DOUBLE) AS Total_Trips
        FROM v_clean JOIN v_partial_purposes USING (POV) GROUP BY POV_Group""",
    "forward_fill": "SELECT pos, spot, k, Activity_Group, Activity FROM v_gappy",
    "activity_classification": "SELECT Activity_Group, Activity, count(*) AS n FROM v_filled GROUP BY ALL",
    "weighted_measures": """SELECT TripIDNumber, CAST(NoNights * SmoothedTripWeight AS DOUBLE) AS Total_Nights,
        CAST(1 AS INT) AS Total_Respondents FROM v_clean JOIN v_stays ON TripIDNumber = TripID""",
    "null_fill": """SELECT TripIDNumber, POV, CAST(ImputedSpendAccom AS DOUBLE) AS ImputedSpendAccom,
        CAST(ImputedSpendTrnsport AS DOUBLE) AS ImputedSpendTrnsport FROM v_clean""",
    "recode_values": " UNION ALL ".join(map(_recoded, q.RULE_SETS)),
    "los_band": f"""SELECT source, {_band("nights")} AS band, count(*) AS n FROM (
        SELECT 'eight' AS source, 8 * (l_quantity - 1) AS nights FROM lineitem
        UNION ALL SELECT 'half', l_quantity / 2 FROM lineitem) GROUP BY ALL""",
    "overnight_filter": """SELECT TripIDNumber, TripType, TripYear, TripQtr FROM v_trips
        WHERE TripType = 'Overnight Trip'""",
    "trip_stay_join": """SELECT Accommodation_Type, CAST(sum(Total_Visitors) AS DOUBLE) AS Total_Visitors,
        CAST(sum(Total_Trips) AS DOUBLE) AS Total_Trips, CAST(sum(Total_Nights) AS DOUBLE) AS Total_Nights,
        CAST(sum(Total_Respondents) AS BIGINT) AS Total_Respondents FROM v_rows_accommodation GROUP BY 1""",
    "activity_join": """SELECT Activity_Group, CAST(sum(Total_Activities) AS DOUBLE) AS Total_Activities,
        count(*) AS n_rows FROM v_rows_activity GROUP BY 1""",
    "activity_base": """SELECT YE, Activity_Group, CAST(sum(Total_Activities) AS DOUBLE) AS Total_Activities,
        count(*) AS Raw_Count FROM v_stacked_activity WHERE YE IN (SELECT YE FROM v_complete_activity) GROUP BY 1, 2""",
    "ri_anti_join": """SELECT 'without trips' AS side, POV FROM v_partial_purposes p
            WHERE NOT EXISTS (SELECT 1 FROM v_clean c WHERE c.POV = p.POV)
        UNION ALL SELECT DISTINCT 'without group', POV FROM v_clean c
            WHERE NOT EXISTS (SELECT 1 FROM v_partial_purposes p WHERE c.POV = p.POV)""",
    "year_end_labels": f"SELECT TripIDNumber, TripYear, TripQtr, {_LABEL_COLUMNS} FROM v_trips",
    "year_end_unpivot": " UNION ALL ".join(
        f"SELECT TripIDNumber, '{p}' AS source, {_label(p, k)} AS YE FROM v_trips" for p, k in LABELS.items()
    ),
    "complete_years": "SELECT YE FROM v_complete_all",
    "quarterly_base": f"""SELECT {_LABEL_COLUMNS}, Destination_RTO, Trip_Type, POV, POV_Group,
        CAST(sum(Total_Visitors) AS DOUBLE) AS Total_Visitors, CAST(sum(Total_Trips) AS DOUBLE) AS Total_Trips,
        CAST(sum(Total_Respondents) AS BIGINT) AS Total_Respondents
        FROM v_rows_trips GROUP BY TripYear, TripQtr, Destination_RTO, Trip_Type, POV, POV_Group""",
    "rolling_year_base": f"""SELECT {", ".join(q.TRIP_DIMS)}, CAST(Total_Visitors AS DOUBLE) AS Total_Visitors,
        CAST(Total_Trips AS DOUBLE) AS Total_Trips, CAST(Total_Respondents AS BIGINT) AS Total_Respondents
        FROM v_base_trips""",
    "partial_grouping_sets": f"""{_cube_query("trips")} WHERE level NOT IN (0, {2 ** len(q.TRIP_DIMS) - 1})""",
    "cube_wide": _wide(),
    "lookup_many": "SELECT Code, Description, Code AS SortOrder FROM v_many_lookup",
    "hierarchy_many": """SELECT (SELECT max(Code) FROM v_many_lookup WHERE Description = 'All') AS Parent, Code AS Child
        FROM v_many_lookup WHERE Description <> 'All'""",
    "loss_accommodation": " UNION ALL ".join(
        [
            _lost("accommodation", "LOS_Group", "v_base_accommodation", "SELECT Description FROM v_bands"),
            _lost("accommodation", "Destination_RTO", "v_base_accommodation", "SELECT Description FROM v_destinations"),
            _lost("accommodation", "Accommodation_Type", "v_base_accommodation", "SELECT Description FROM v_types"),
        ]
    ),
    "loss_purposes": _lost("trips", "POV", "v_clean_measures", "SELECT POV FROM v_partial_purposes"),
    "loss_activities": _lost(
        "activity", "Activities", "v_clean_activities", "SELECT Activity FROM v_classification WHERE Activity_Group <> 'PROMO'"
    ),
    "grand_total": f"""SELECT {", ".join(f"'All' AS {d}" for d in q.TRIP_DIMS)},
        {", ".join(f"CAST(sum({m}) AS DOUBLE) AS {m}" for m in q.TRIP_MEASURES)} FROM v_base_trips""",
    "grouping_count": """SELECT CAST(level AS BIGINT) AS level, count(*) AS n_rows,
        (SELECT count(DISTINCT level) FROM v_cube_trips) AS n_sets FROM v_cube_trips GROUP BY level""",
    "spend_pivot": """SELECT TripIDNumber, CAST(Alcohol AS DOUBLE) AS Alcohol,
        CAST(FoodAndAlcohol AS DOUBLE) AS FoodAndAlcohol FROM v_wide_spend""",
    "net_component": """SELECT TripIDNumber, CAST(Alcohol AS DOUBLE) AS Alcohol,
        CAST(FoodAndAlcohol - Alcohol AS DOUBLE) AS FoodAndBeverages FROM v_wide_spend""",
    "spend_unpivot": """SELECT TripIDNumber, 'Alcohol' AS SpendType, CAST(Alcohol AS DOUBLE) AS Expenditure
            FROM v_wide_spend
        UNION ALL SELECT TripIDNumber, 'FoodAndBeverages', CAST(FoodAndAlcohol - Alcohol AS DOUBLE)
            FROM v_wide_spend""",
    "spend_long": "SELECT TripIDNumber, SpendType, CAST(Expenditure AS DOUBLE) AS Expenditure FROM v_long_spend",
    "year_end_lookup": f"""SELECT Code, Description, Code AS SortOrder, YE
        FROM ({_year_lookup("v_complete_all", "YE")})""",
    "lookup_generated": "SELECT Code, Description, Code AS SortOrder FROM v_pov_lookup",
    "dim_hierarchy": """SELECT (SELECT max(Code) FROM v_pov_lookup WHERE Description = 'All') AS Parent, Code AS Child
        FROM v_pov_lookup WHERE Description <> 'All'""",
    "lookup_publish": """SELECT Code, '"' || Description || '"' AS Description, '' AS SortOrder FROM v_pov_lookup""",
    "encode_dimensions": _encode_trips(),
    "encode_loss": """SELECT count(*) AS rows_before,
            count(*) FILTER (a AND b AND c) AS rows_after, count(*) FILTER (NOT a) AS lost_LOS_Group,
            count(*) FILTER (NOT b) AS lost_Destination_RTO, count(*) FILTER (NOT c) AS lost_Accommodation_Type
        FROM (SELECT LOS_Group IN (SELECT Description FROM v_bands) AS a,
                     Destination_RTO IN (SELECT Description FROM v_destinations) AS b,
                     Accommodation_Type IN (SELECT Description FROM v_types) AS c FROM v_cube_accommodation)""",
    "format_measures": f"""SELECT {", ".join(q.TRIP_DIMS)}, {_text("Total_Trips", 0)} AS trips_0,
        {_text("Total_Visitors", 2)} AS visitors_2,
        {_text("CAST(Total_Visitors AS DOUBLE) / 4", 0)} AS visitors_quarter_0,
        {_text("Total_Respondents", 0)} AS respondents_0 FROM v_cube_trips""",
    "reconcile_totals": " UNION ALL ".join(
        [
            _trip_type_control("Day Trip"),
            _trip_type_control("Overnight Trip"),
            _control(
                "trip type against purpose",
                _BY.format(q.CONTROL_YEAR, "Trip_Type"),
                _BY.format(q.CONTROL_YEAR, "POV_Group"),
                "< 0.5",
            ),
            _control(
                "Total_Trips YEDec2000",
                "SELECT sum(Total_Trips) FROM v_base_trips WHERE Year_Ending = 'YEDec2000'",
                _YEAR_2000,
                "< 0.5",
            ),
            _control(
                f"Total_Respondents {q.CONTROL_YEAR}",
                f"SELECT sum(Total_Respondents) FROM v_base_trips WHERE Year_Ending = '{q.CONTROL_YEAR}'",
                "SELECT 1",
            ),
            _control(
                "Raw_Count of quarterly",
                "SELECT count(*) FROM v_clean JOIN v_activities ON TripIDNumber = TripID",
                "SELECT count(*) FROM lineitem",
            ),
            _control(
                "SmoothedTripWeight of trips_with_details 1998 3",
                _WITH_ACTIVITY,
                _WITH_ACTIVITY,
                "< 0.5",
            ),
        ]
    ),
    "distinct_trip_total": """SELECT CAST(sum(SmoothedTripWeight) AS DOUBLE) AS total FROM v_clean
        WHERE TripYear = 1998 AND TripQtr = 3 AND TripIDNumber IN (SELECT TripID FROM v_activities)""",
    "null_audit": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM v_trips"
        for c in (
            "TripIDNumber", "TripYear", "TripQtr", "TripType", "DestinationRTO", "POV", "RespondentWeight",
            "SmoothedTripWeight", "ExpenditureWeight", "ImputedSpendAccom", "ImputedSpendTrnsport",
        )
    ),
    "rule_zero_sum": _control(
        "accommodation spend of day trips",
        "SELECT sum(ExpenditureWeight * ImputedSpendAccom) FROM v_clean WHERE TripType = 'Day Trip'",
        "SELECT 0",
    )
    + " UNION ALL "
    + _control(
        "accommodation spend of turned trips",
        "SELECT sum(ExpenditureWeight * ImputedSpendAccom) FROM v_clean WHERE TripType <> 'Day Trip'",
        "SELECT 0",
    ),
    "quarter_end_date": "SELECT QEDate, TripYear, TripQtr FROM v_quarters",
    "lagged_month_end": """SELECT QEDate, CAST(last_day(QEDate - INTERVAL 3 MONTH) AS DATE) AS less3m,
        CAST(last_day(QEDate - INTERVAL 9 MONTH) AS DATE) AS less9m FROM v_quarters""",
    "whole_years_lag": "SELECT whole_year, TripYear, TripQtr, lagged, less9m FROM v_whole_years",
    "component_quarters": """SELECT DISTINCT CAST(last_day(whole_year - n * INTERVAL 1 MONTH) AS DATE) AS quarter_end
        FROM v_whole_years, (VALUES (0), (3), (6), (9)) AS o(n)""",
}
STATEMENTS |= {f"cube_{n}": _cube_query(n) for n in q.SPECS}
STATEMENTS |= {f"extract_{n}": _extract_query(n) for n in q.SPECS}

ORACLE = {name: _with(sql) for name, sql in STATEMENTS.items()}

# The same outcome on another way: one pass for all extracts, and totals kept and corrected by quarter.
ORACLE |= {
    "shared_cube_spend": ORACLE["cube_spend"],
    "corrected_trips": ORACLE["rolling_year_base"],
    "corrected_accommodation": ORACLE["cube_accommodation"],
}
