"""Sums of floating-point columns that do not depend on the order of the rows.

A double is a whole number times a power of two, so it can be cut at fixed places of its binary
digits.  Each value is cut into limbs of WIDTH bits: whole numbers of multiples of 2^(WIDTH * slot).
Limbs of one slot are summed as BIGINT, which loses nothing, and the sums are put together and
rounded once.  The result is the double nearest to the true sum, whatever the order of rows, tasks
and partial sums, and whatever the sizes of the values.

The slots in CORE hold amounts as they usually are, and are columns of the rollup.  What a value has
above or below them, and infinities, become rows of their own beside it, grouped by slot, of which a
double has less than a hundred.  So no group's sums grow with its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.functions.measures import Measure

#: Bits of a limb; a BIGINT sums limbs of 2^(63 - WIDTH) rows.
WIDTH = 24
UNIT = 1 << WIDTH
#: Slots that are columns: values below 2^48, down to multiples of 2^-72.
CORE = (-3, -2, -1, 0, 1)
#: All slots that digits of a double or carries of a sum fall in, and three more below them.
SLOTS = (-50, 46)
#: Places in the list of tails that count infinite values.
INFINITE = {1: 100, -1: 101}
#: Lowers the lowest doubles' distance from zero: multiplying by 2^(WIDTH * LIFT) is exact for them.
LIFT = 20

_NONE = "CAST(array() AS ARRAY<STRUCT<slot: INT, limb: BIGINT>>)"


def _double(value: float) -> str:
    return f"{value!r}D"


def _power(exponent: str) -> str:
    return f"pow(2.0D, CAST({exponent} AS DOUBLE))"


def _limbs(value: str, lift: int) -> str:
    """The limbs of a nonzero double as (slot, limb), five at most."""
    lifted = f"{value} * {_double(2.0 ** (WIDTH * lift))}"
    # a logarithm rounded across a power of two only makes the first limb one bit longer or zero
    top = f"CAST(floor(log2(abs({lifted})) / {WIDTH}.0D) AS INT)"
    unit = _power(f"(s.top - i) * {WIDTH}")
    limb = f"CAST(s.rest / {unit} AS BIGINT)"
    return f"""filter(aggregate(array(0, 1, 2, 3, 4),
        named_struct('top', {top}, 'rest', {lifted}, 'found', {_NONE}),
        (s, i) -> named_struct('top', s.top, 'rest', s.rest - {limb} * {unit}, 'found',
            array_append(s.found, named_struct('slot', s.top - i - {lift}, 'limb', {limb}))),
        s -> s.found), e -> e.limb <> 0)"""


def _split(df: DataFrame, doubles: Sequence[str]) -> DataFrame:
    """Add for the i-th column its core limbs ``_{slot}_{i}`` and ``_tails``, all it has beside them.

    NaN counts as missing.  Each step reads the one before, so it is a projection of its own.
    """
    bound, infinite = _double(2.0 ** (2 * WIDTH)), "CAST('Infinity' AS DOUBLE)"
    values, rests, parts, smalls, out = {}, {}, {}, {}, {}
    tails = []
    for i, name in enumerate(doubles):
        given = f"CAST(`{name}` AS DOUBLE)"
        values[f"_x_{i}"] = f"CASE WHEN NOT isnan({given}) THEN {given} END"
        rests[f"_rest_{i}"] = f"CASE WHEN abs(_x_{i}) < {infinite} THEN _x_{i} % {bound} END"
        parts[f"_part_{i}"] = f"(_rest_{i} - CAST(_rest_{i} AS BIGINT)) * {bound}"
        smalls[f"_small_{i}"] = f"(_part_{i} - CAST(_part_{i} AS BIGINT)) * {_double(float(UNIT))}"
        # BIGINT division and remainder cut towards zero, as the casts do
        out[f"_1_{i}"] = f"CAST(_rest_{i} AS BIGINT) div {UNIT}"
        out[f"_0_{i}"] = f"CAST(_rest_{i} AS BIGINT) % {UNIT}"
        out[f"_-1_{i}"] = f"CAST(_part_{i} AS BIGINT) div {UNIT}"
        out[f"_-2_{i}"] = f"CAST(_part_{i} AS BIGINT) % {UNIT}"
        out[f"_-3_{i}"] = f"CAST(_small_{i} AS BIGINT)"
        unit = _double(2.0 ** (WIDTH * CORE[0]))
        low = f"((_small_{i} - CAST(_small_{i} AS BIGINT)) * {unit})"
        high = f"(_x_{i} - _rest_{i})"
        endless = f"""array(named_struct('slot', CASE WHEN _x_{i} > 0 THEN {INFINITE[1]}
            ELSE {INFINITE[-1]} END, 'limb', 1L))"""
        tails.append(
            f"""transform(CASE WHEN _x_{i} IS NULL OR ({high} = 0 AND {low} = 0) THEN {_NONE}
            WHEN _rest_{i} IS NULL THEN {endless}
            ELSE concat(CASE WHEN {high} <> 0 THEN {_limbs(high, 0)} ELSE {_NONE} END,
                CASE WHEN {low} <> 0 THEN {_limbs(low, LIFT)} ELSE {_NONE} END) END,
            e -> named_struct('measure', {i}, 'slot', e.slot, 'limb', e.limb))"""
        )
    out["_tails"] = f"concat({', '.join(tails)})"
    for step in (values, rests, parts, smalls, out):
        df = df.withColumns({name: F.expr(text) for name, text in step.items()})
    return df


def _carried(core: Mapping[int, str]) -> dict[int, str]:
    """The sum of each core slot with the carry of those below; its digit is in the last WIDTH bits.

    The carry of the highest is left in it, so its sign is that of the whole.
    """
    carried: dict[int, str] = {}
    for slot in CORE:
        below = carried.get(slot - 1)
        carried[slot] = core[slot] if below is None else f"({core[slot]} + shiftright({below}, {WIDTH}))"
    return carried


def _with_totals(df: DataFrame, count: int) -> DataFrame:
    """Add ``_sum_{i}``, the double nearest to the sum of all limbs in ``_total_{i}``."""
    negative, size, out = {}, {}, {}
    for i in range(count):
        core = {s: f"_total_{i}.s{s + 9}" for s in CORE}
        sizes = {s: f"_size{s + 9}_{i}" for s in CORE}
        negative[f"_negative_{i}"] = f"{_carried(core)[CORE[-1]]} < 0"
        size |= {sizes[s]: f"CASE WHEN _negative_{i} THEN -{core[s]} ELSE {core[s]} END" for s in CORE}
        carried = _carried(sizes)
        top = carried[CORE[-1]]
        d0, d1, d2, d3 = (f"({carried[s]} & {UNIT - 1})" for s in reversed(CORE[:-1]))
        pair = lambda high, low: f"({high} * {UNIT} + {low})"
        last = f"({pair(d1, d2)} | CASE WHEN {d3} <> 0 THEN 1L ELSE 0L END)"
        bound = _double(2.0 ** (2 * WIDTH))
        # as in _rounded: two exact doubles, whose sum is rounded once
        large = f"(CAST({pair(top, d0)} AS DOUBLE) * {bound} + {last}) / {bound}"
        small = f"(CAST({pair(d0, d1)} AS DOUBLE) * {bound} + {pair(d2, d3)}) / {_double(2.0 ** (3 * WIDTH))}"
        usual = f"(CASE WHEN _negative_{i} THEN -1.0D ELSE 1.0D END) * CASE WHEN {top} > 0 THEN {large} ELSE {small} END"
        tails = f"_total_{i}.tails"
        out[f"_sum_{i}"] = f"""CASE WHEN size({tails}) = 0 AND {top} < {1 << 28}L THEN {usual}
            ELSE {_recombine(core, tails)} END"""
    for step in (negative, size, out):
        df = df.withColumns({name: F.expr(text) for name, text in step.items()})
    return df


def _recombine(core: Mapping[int, str], tails: str) -> str:
    """The double nearest to the sum of all limbs, wherever they lie."""
    known = ", ".join(f"named_struct('slot', {s}, 'limb', {core[s]})" for s in CORE)
    limbs = f"""transform(sequence({SLOTS[0]}, {SLOTS[1]}), slot -> aggregate(
        filter(concat({tails}, array({known})), e -> e.slot = slot), 0L, (sum, e) -> sum + e.limb))"""
    above, below = (f"exists({tails}, e -> e.slot = {INFINITE[s]})" for s in (1, -1))
    return f"""CASE WHEN {above} AND {below} THEN CAST('NaN' AS DOUBLE)
        WHEN {above} THEN CAST('Infinity' AS DOUBLE) WHEN {below} THEN CAST('-Infinity' AS DOUBLE)
        ELSE {_rounded(limbs)} END"""


def _digits(limbs: str) -> str:
    """Digits from 0 to UNIT - 1, lowest first, and the carry beyond the last: negative for a negative sum."""
    return f"""aggregate({limbs}, named_struct('carry', 0L, 'digits', CAST(array() AS ARRAY<BIGINT>)),
        (c, limb) -> named_struct('carry', shiftright(c.carry + limb, {WIDTH}),
            'digits', array_append(c.digits, (c.carry + limb) & {UNIT - 1})))"""


def _rounded(limbs: str) -> str:
    """The nearest double to the sum of limbs of all SLOTS; the lowest three are 0.

    The first two digits other than zero and the next two make two exact doubles; if any digit
    follows, the last bit is set.  Their sum is then rounded as the whole sum would be.
    """
    sign = f"CASE WHEN {_digits(limbs)}.carry < 0 THEN -1L ELSE 1L END"
    digits = f"{_digits('transform(signed.limbs, limb -> signed.sign * limb)')}.digits"
    started = "(s.n > 0 OR d <> 0)"
    into = lambda name, when: f"CASE WHEN {started} AND {when} THEN s.{name} * {UNIT} + d ELSE s.{name} END"
    both = f"(CAST(s.high AS DOUBLE) * {_double(2.0 ** (2 * WIDTH))} + (s.low | CASE WHEN s.more THEN 1L ELSE 0L END))"
    # in two steps for the lowest slots, whose power is not a double
    lifted = f"{both} * {_power(f'(s.slot + {LIFT}) * {WIDTH}')} * {_double(2.0 ** (-WIDTH * LIFT))}"
    size = f"""aggregate(reverse({digits}),
        named_struct('n', 0, 'high', 0L, 'low', 0L, 'more', false, 'slot', {SLOTS[1] + 1}),
        (s, d) -> named_struct('n', CASE WHEN {started} THEN s.n + 1 ELSE s.n END,
            'high', {into("high", "s.n < 2")}, 'low', {into("low", "s.n >= 2 AND s.n < 4")},
            'more', s.more OR (s.n >= 4 AND d <> 0),
            'slot', CASE WHEN s.n < 4 THEN s.slot - 1 ELSE s.slot END),
        s -> CASE WHEN s.slot < 0 THEN {lifted} ELSE {both} * {_power(f"s.slot * {WIDTH}")} END)"""
    # a lambda over one element names the limbs and their sign
    return f"""transform(array(named_struct('limbs', {limbs}, 'sign', {sign})),
        signed -> signed.sign * {size})[0]"""


def is_double(kind: T.DataType) -> bool:
    return isinstance(kind, T.FloatType | T.DoubleType)


def raw(measure: Measure) -> Column:
    """A measure over a column that isn't floating-point, in one grouping."""
    column = F.col(f"`{measure.column}`")
    if measure.how == "mean":
        return F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double"))
    return {"sum": F.sum, "count": F.count, "distinct": F.count_distinct}[measure.how](column)


def grouped(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Measure]) -> DataFrame:
    """Group by ``keys``; measures over floating-point columns are exact and rounded once.

    Sums keep the type of their column, or are DOUBLE; a sum or mean over NULLs only is NULL.
    Infinite values follow IEEE, NaN counts as missing.  Rows are first grouped by the keys
    and by the slot of what lies outside CORE, with partial sums before the shuffle, then by the keys alone.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    summed = [m.column for m in measures.values() if m.how in ("sum", "mean")]
    doubles = [c for c in dict.fromkeys(summed) if is_double(types[c])]
    if not doubles:
        return df.groupBy(*keys).agg(*(raw(m).alias(name) for name, m in measures.items()))
    apart = list(dict.fromkeys(m.column for m in measures.values() if m.how == "distinct"))
    df = _split(df, doubles)
    own = F.array(F.struct(F.lit(-1).alias("measure"), F.lit(0).alias("slot"), F.lit(0).cast("bigint").alias("limb")))
    df = df.withColumn("_tail", F.explode(F.concat(own, "_tails")))
    main = F.col("_tail.measure") == -1
    first, second = {}, {}

    def add(name: str, column: str, counted: bool) -> Column:
        """A column that adds up over both groupings."""
        part = F.when(main, F.col(f"`{column}`"))
        first[name] = F.count(part) if counted else F.sum(part)
        return F.sum(f"`{name}`")

    for i, column in enumerate(doubles):
        core = {s: F.coalesce(add(f"_{s}_{i}", f"_{s}_{i}", False), F.lit(0)) for s in CORE}
        here = F.when(F.col("_measure") == i, F.struct(F.col("_slot").alias("slot"), F.col("_limb").alias("limb")))
        # one row for each slot at most
        second[f"_total_{i}"] = F.struct(
            *(c.alias(f"s{s + 9}") for s, c in core.items()), F.collect_list(here).alias("tails"),
            add(f"_count_{i}", f"_x_{i}", True).alias("n"),
        )
    for name, m in measures.items():
        if m.column in doubles and m.how in ("sum", "mean"):
            continue
        if m.how == "distinct":
            second[name] = F.count_distinct(f"_d_{apart.index(m.column)}")
        elif m.how == "count":
            second[name] = F.coalesce(add(f"_n_{name}", m.column, True), F.lit(0))
        elif isinstance(types[m.column], T.BooleanType):
            raise TypeError(f"cast {m.column!r} to a number first")
        else:
            total = add(f"_t_{name}", m.column, False)
            second[name] = total
            if m.how == "mean":
                n = add(f"_n_{name}", m.column, True)
                second[name] = F.try_divide(total.cast("double"), n.cast("double"))
    distinct = [F.when(main, F.col(f"`{c}`")).alias(f"_d_{i}") for i, c in enumerate(apart)]
    slots = [F.col("_tail.measure").alias("_measure"), F.col("_tail.slot").alias("_slot")]
    first["_limb"] = F.sum("_tail.limb")
    once = df.groupBy(*keys, *distinct, *slots).agg(*(c.alias(n) for n, c in first.items()))
    found = once.groupBy(*keys).agg(*(c.alias(n) for n, c in second.items()))
    found = _with_totals(found, len(doubles))
    out = []
    for name, m in measures.items():
        if m.column in doubles and m.how in ("sum", "mean"):
            i = doubles.index(m.column)
            n = F.col(f"_total_{i}")["n"]
            value = F.when(n > 0, F.col(f"_sum_{i}"))
            if m.how == "mean":
                value = value / n.cast("double")
        else:
            value = F.col(f"`{name}`")
        out.append(value.alias(name))
    return found.select(*keys, *out)
