"""Status intervals, milestones, holds and schedule dates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowframe.functions.bizdays import add_workdays, parse_day
from flowframe.operators.relational import join
from flowframe.operators.windows import ordered_neighbours

def status_intervals(
    status: DataFrame,
    keys: Sequence[str],
    scope: str = "statustype",
    code: str = "objectstatuscode",
    change: str = "objectchangenum",
    inactive: str = "objectinactive",
    start: str = "starttime",
) -> DataFrame:
    """Active status rows as intervals.

    An inactive row with change number n+1 and the same scope and code closes the interval
    opened by change n; an open interval ends in empty text. The join key holds the change
    number, so a long status history spreads over the reducers.
    """
    number = F.col(change).cast("string").try_cast("bigint")
    active = F.coalesce(F.col(inactive), F.lit("")) != "X"
    opened = status.filter(active).select(
        *keys, scope, F.col(code).alias("statevalue"), F.col(start).alias("starttime"), number.alias("__n")
    )
    closed = (
        status.filter(F.col(inactive) == "X")
        .groupBy(*keys, scope, F.col(code).alias("statevalue"), (number - 1).alias("__n"))
        .agg(F.max(start).alias("endtime"))
    )
    joined = join(opened, closed, [*keys, scope, "statevalue", "__n"], "left")
    return joined.select(
        *keys,
        scope,
        F.col("__n").alias("changenum"),
        "statevalue",
        "starttime",
        F.coalesce("endtime", F.lit("")).alias("endtime"),
    )


def hold_sequence(holds: Mapping[tuple[str, ...], int], cols: Sequence[str]) -> Column:
    """Sequence of a hold from its key columns, null when it is not listed.

    The list is configuration, given as a dictionary, so it is part of the expression: large
    interval tables are neither joined nor shuffled by the few values of the key.
    """
    mark = "\x1f"
    pairs = [F.lit(x) for key, seq in holds.items() for x in (mark.join(key), seq)]
    return F.try_element_at(F.create_map(*pairs), F.concat_ws(mark, *cols))


def active_min_sequence(
    intervals: DataFrame,
    holds: Mapping[tuple[str, ...], int],
    keys: Sequence[str],
    scope: str = "statustype",
    lead: Sequence[str] = (),
) -> DataFrame:
    """Of the open intervals in a hold list, the one with the lowest sequence per object.

    `holds` maps (*lead, scope, state value) to a sequence. Item holds win a tie against
    header holds, then the lower value; of its intervals the latest start counts.
    """
    sequence = hold_sequence(holds, [*lead, scope, "statevalue"])
    open_holds = intervals.filter("endtime = ''").withColumn("sequence", sequence).filter("sequence IS NOT NULL")
    per_state = open_holds.groupBy(*keys, scope, "statevalue", "sequence").agg(F.max("starttime").alias("starttime"))
    rank = F.struct(
        F.col("sequence"),
        F.when(F.col(scope) == "item", F.lit(0)).otherwise(F.lit(1)),
        F.col("statevalue"),
    )
    found = F.struct(scope, "statevalue", "sequence", "starttime")
    best = per_state.groupBy(*keys).agg(F.min_by(found, rank).alias("b"))
    trace = F.concat(F.lit("statustype:"), F.col(f"b.{scope}"), F.lit(" | sequence: "), F.col("b.sequence").cast("string"))
    return best.select(*keys, "b.statevalue", "b.starttime", F.lit("").alias("endtime"), trace.alias("trace"))


def status_flag_intervals(
    intervals: DataFrame, codes: Mapping[str, Sequence[str]], client: str = "client", scope: str = "statustype"
) -> DataFrame:
    """Header intervals of the flag codes of each source system."""
    wanted = F.lit(False)
    for name, listed in codes.items():
        wanted = wanted | ((F.col(client) == name) & F.col("statevalue").isin(list(listed)))
    return intervals.filter((F.col(scope) == "header") & wanted)


def milestone_chain(df: DataFrame, keys: Sequence[str], milestones: Sequence[tuple[int, str, Column]]) -> DataFrame:
    """One row per reached milestone; it ends where the next reached one starts.

    `milestones` is (sequence, name, start). The chain is built inside each row: no shuffle.
    """
    steps = F.array(
        *[
            F.struct(F.lit(seq).alias("seq"), F.lit(name).alias("milestone"), start.cast("string").alias("starttime"))
            for seq, name, start in sorted(milestones, key=lambda m: m[0])
        ]
    )
    reached = F.filter(steps, lambda s: F.coalesce(s["starttime"], F.lit("")) != "")
    rows = df.select(*keys, reached.alias("__reached"))
    chained = F.transform(
        F.col("__reached"),
        lambda s, i: F.struct(
            s["seq"].alias("seq"),
            s["milestone"].alias("milestone"),
            s["starttime"].alias("starttime"),
            F.coalesce(F.try_element_at(F.col("__reached"), i + 2)["starttime"], F.lit("")).alias("endtime"),
        ),
    )
    return rows.select(*keys, F.explode(chained).alias("m")).select(*keys, "m.*")


def latest_entry(entries: Column, where: Callable[[Column], Column], order: str, value: str) -> Column:
    """`value` of the entry with the greatest `order` among those of a list that satisfy `where`;
    empty without one."""
    newest = F.array_max(F.transform(F.filter(entries, where), lambda p: F.struct(p[order].alias("o"), p[value].alias("v"))))
    return F.coalesce(newest["v"], F.lit(""))


def latest_values(
    lines: DataFrame, keys: Sequence[str], order: Column | str, value: Column | str, wanted: Mapping[str, Column | str]
) -> DataFrame:
    """Per group and name in `wanted`: `value` of the line with the greatest `order` among those that
    satisfy its condition (of equal ones the greater value); empty without one.

    As `latest_entry`, but combined on the map side: the lines of a group are never gathered.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    entry = F.struct(col(order).alias("o"), col(value).alias("v"))
    newest = {n: F.max(F.when(F.expr(c) if isinstance(c, str) else c, entry))["v"] for n, c in wanted.items()}
    return lines.groupBy(*keys).agg(*[F.coalesce(v, F.lit("")).alias(n) for n, v in newest.items()])


def schedule_commit_dates(
    lines: DataFrame,
    keys: Sequence[str],
    today: str,
    hub_flows: Sequence[str],
    newer: Sequence[str],
    older: Sequence[str],
    client: str = "client",
    flow: str = "flowtype",
    quantity: str = "schedulelineconfirmedqty",
    ship_date: str = "plannedfactoryshipdate",
    serial: str = "serial",
    line: str = "schedulelinenum",
    check_serial: str = "atpserial",
) -> DataFrame:
    """Commit date of each schedule line, valid until the next line changes it.

    Lines are taken in order of serial and line number. A confirmed line commits to its ship
    date (two working days later through a hub); an unconfirmed one to nine (hub) or seven
    working days after its own change, or after `today` when it is the latest. In the newer
    system a line confirmed no later than the availability check counts nine days through a
    hub and otherwise has no date of its own: it keeps the date before it. Lines of systems that
    are neither in `newer` nor in `older` have no date and are left out.
    """
    c = F.col
    order = [serial, line]
    month = F.substring(serial, 1, 6)

    lines = lines.filter(c(client).isin([*newer, *older]))
    hub = F.coalesce(c(flow).isin(list(hub_flows)), F.lit(False))
    confirmed = F.coalesce(c(quantity).cast("string").try_cast("double"), F.lit(0.0)) >= 1
    checked = c(client).isin(list(newer)) & (c(serial) <= F.coalesce(c(check_serial), F.lit("")))
    rows = lines.select(
        *keys,
        line,
        serial,
        F.struct(
            c(serial).alias("serial"),
            c(ship_date).alias("ship"),
            hub.alias("hub"),
            confirmed.alias("confirmed"),
            F.coalesce(checked, F.lit(False)).alias("checked"),
        ).alias("__facts"),
    )
    f = c("__facts")
    through_hub = parse_day(f["ship"]).isNotNull()
    dated = (
        F.when(f["confirmed"] & f["checked"], f["hub"])
        .when(f["confirmed"], F.when(f["hub"], through_hub).otherwise(F.coalesce(f["ship"], F.lit("")) != ""))
        .otherwise(F.lit(True))
    )
    # what decides a date travels; the date itself is worked out once, behind the shuffle
    rows = ordered_neighbours(
        rows.withColumn("__facts", F.when(dated, f)),
        keys,
        order,
        month,
        following={"__end": serial},
        carried={"__own": "__facts"},
        highest={"__last": serial},
    )
    own = c("__own")
    rows = rows.filter("__own IS NOT NULL").withColumns(
        {
            "__from": F.when(own["serial"] == c("__last"), F.lit(today)).otherwise(own["serial"]),
            "__days": F.when(own["confirmed"] & ~own["checked"], 2).when(own["hub"], 9).otherwise(7),
        }
    )
    rows = rows.withColumn("__day", parse_day(F.when(c("__days") == 2, own["ship"]).otherwise(c("__from"))))
    counted = F.date_format(add_workdays(c("__day"), c("__days")), "yyyyMMdd")
    direct = own["confirmed"] & ~own["checked"] & ~own["hub"]
    return rows.select(
        *keys,
        line,
        F.when(direct, own["ship"]).otherwise(counted).alias("datevalue"),
        F.col(serial).alias("starttime"),
        F.coalesce("__end", F.lit("")).alias("endtime"),
    )
