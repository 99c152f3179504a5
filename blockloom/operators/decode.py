"""Raw logs to typed events, and back: column expressions over the log's topics and data words."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import u256 as U
from ..plans.catalog import CONTRACTS, EVENTS, Event, Field

WORD = 64
DYNAMIC = ("u256[]", "bytes")
BY_ADDRESS = {a: c for c, a in CONTRACTS.items()}
_HEX = "^[0-9a-f]*$"


def prepared(raw: DataFrame) -> DataFrame:
    """Logs with topic0, the data as whole bytes in lower case without 0x, and the common fields."""
    body = F.lower(U.strip0x(F.coalesce("data", F.lit(""))))
    body = F.when(F.length(body) % 2 == 1, F.concat(F.lit("0"), body)).otherwise(body)
    contract = F.element_at(F.create_map(*[F.lit(x) for kv in BY_ADDRESS.items() for x in kv]), F.lower("address"))
    columns = (
        F.lower(F.get("topics", F.lit(0))).alias("topic0"), F.col("topics").alias("topics"), body.alias("body"), F.lower("address").alias("address"), contract.alias("contract"),
        U.parse_hex(F.col("blockNumber")).alias("block_number"), U.parse_hex(F.col("transactionIndex")).alias("transaction_index"),
        F.col("transactionHash").alias("transaction_hash"), U.parse_hex(F.col("logIndex")).alias("log_index"),
    )
    # a generator keeps the optimizer from writing these expressions out at each of their hundreds of uses
    return raw.select(F.inline(F.array(F.struct(*columns))))


def _topic(f: Field) -> Column:
    return F.lower(U.strip0x(F.get("topics", F.lit(int(f.place[1])))))


def _word(i: int | Column) -> Column:
    """Word i of the data; beyond the end of empty data zeros, as empty data stands for zeros."""
    at = F.lit(i) if isinstance(i, int) else i
    return F.when(F.col("body") == "", F.lit("0" * WORD)).otherwise(F.substr(F.col("body"), (at * WORD + 1).cast("int"), F.lit(WORD)))


def _small(word: Column) -> Column:
    """A word to a bigint, null if it does not fit."""
    return F.when(word.startswith("0" * 49), F.conv(word, 16, 10).cast("long"))


def _offset(f: Field) -> Column:
    return _small(_word(int(f.place[1])))


def _length(f: Field) -> Column:
    """Items of a dynamic field, from the word at its offset (in hex digits)."""
    return _small(F.substr(F.col("body"), (_offset(f) * 2 + 1).cast("int"), F.lit(WORD)))


def _value(f: Field, ids_in_hex: bool = False) -> Column:
    w = _topic(f) if f.place[0] == "t" else _word(int(f.place[1]))
    if ids_in_hex and f.kind == "token":
        return w
    if f.kind == "b32":
        return F.concat(F.lit("0x"), w)
    if f.kind == "addr":
        return F.concat(F.lit("0x"), F.right(w, F.lit(40)))
    if f.kind in ("token", "u256"):
        return U.u256_dec(w)
    if f.kind == "i256":
        return U.i256_dec(w)
    if f.kind == "u32":
        return _small(w)
    start, n = (_offset(f) * 2 + 1 + WORD).cast("int"), _length(f)
    if f.kind == "bytes":
        return F.concat(F.lit("0x"), F.substr(F.col("body"), start, (n * 2).cast("int")))
    return F.when(n == 0, "[]").otherwise(F.to_json(U.u256_decs(_items(f))))


def _items(f: Field) -> Column:
    """The words of a dynamic field of numbers."""
    start, n = (_offset(f) * 2 + 1 + WORD).cast("int"), _length(f)
    return F.when(n > 0, F.transform(F.sequence(F.lit(1).cast("long"), n), lambda i: F.substr(F.col("body"), (start + (i - 1) * WORD).cast("int"), F.lit(WORD))))


def _has_topics(e: Event) -> Column:
    rules = [F.coalesce(_topic(f).rlike("^[0-9a-f]{64}$"), F.lit(False)) for f in e.topics]
    return reduce(lambda a, b: a & b, [F.size("topics") > len(e.topics), *rules])


def _has_data(e: Event) -> Column:
    if not e.words:
        return F.lit(True)
    full = F.length("body") >= WORD * len(e.words)
    for f in e.words:
        if f.kind in DYNAMIC:
            size = _length(f) * (WORD if f.kind == "u256[]" else 2)
            full = full & F.coalesce((_offset(f) * 2 + WORD + size) <= F.length("body"), F.lit(False))
        elif f.kind == "addr":
            full = full & _word(int(f.place[1])).startswith("0" * 24)
        elif f.kind == "u32":
            full = full & _small(_word(int(f.place[1]))).isNotNull()
    numbers = all(f.kind in ("u256", "token", "u32") for f in e.words)
    return F.col("body").rlike(_HEX) & (full | (F.col("body") == "") if numbers else full)


def well_formed(e: Event) -> Column:
    """Whether a log of this event has its topics and all the data that its fields point at, in hex.

    Empty data is fine for events whose data fields are all plain numbers."""
    return _has_topics(e) & _has_data(e)


def decode(raw: DataFrame, key: str, ids_in_hex: bool = False) -> DataFrame:
    """The well-formed logs of one event: contract, the common fields and the event's columns. Token ids are decimal, or
    (ids_in_hex) the 64 digits that storage makes bytes of."""
    e = EVENTS[key]
    rows = prepared(raw).where((F.col("topic0") == e.topic0)).where(well_formed(e))
    return rows.select("contract", "block_number", "transaction_index", "transaction_hash", "log_index", *(_value(f, ids_in_hex).alias(f.name) for f in e.fields))


#: Where a field can stand: three topics and five words of data.
SLOTS = ("t1", "t2", "t3", "d0", "d1", "d2", "d3", "d4")
_EVENT_OF = {e.topic0: e.key for e in EVENTS.values()}
_NUMBERS = ("u256", "u32")


def _lookup(of: dict, c: str) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in of.items() for x in kv]), F.col(c))


def _has(slot: str, *kinds: str) -> list[str]:
    """The events that have a field of one of these kinds in a slot."""
    return [e.key for e in EVENTS.values() for f in e.fields if f.place == slot and f.kind in kinds]


def _known(raw: DataFrame) -> DataFrame:
    """Logs of known events with the event's name, what stands in each slot, the offset `at` and items `n` of the dynamic field
    (an event has one at most), and whether the payload is well formed.

    Each rule names the events it holds for, so one expression serves all events; generators keep the optimizer from writing
    what stands in the slots out at each use."""
    rows = prepared(raw).where(F.col("topic0").isin(list(_EVENT_OF)))
    topics = [F.lower(U.strip0x(F.get("topics", F.lit(int(x[1]))))).alias(x) for x in SLOTS if x[0] == "t"]
    words = [_word(int(x[1])).alias(x) for x in SLOTS if x[0] == "d"]
    rows = rows.select(F.inline(F.array(F.struct("*", _lookup(_EVENT_OF, "topic0").alias("event"), *topics, *words))))
    first = F.coalesce(*(F.when(F.col("event").isin(_has(x, *DYNAMIC)), F.col(x)) for x in SLOTS if _has(x, *DYNAMIC)))
    rows = rows.select(F.inline(F.array(F.struct("*", _small(first).alias("at")))))
    rows = rows.select(F.inline(F.array(F.struct("*", _small(F.substr(F.col("body"), (F.col("at") * 2 + 1).cast("int"), F.lit(WORD))).alias("n")))))
    event, size, false = F.col("event"), F.length("body"), F.lit(False)
    has_topics = reduce(lambda a, b: a & b, (~event.isin([e.key for e in EVENTS.values() if len(e.topics) > i]) | F.coalesce(F.col(x).rlike("^[0-9a-f]{64}$"), false) for i, x in enumerate(SLOTS[:3])))
    rules = [size >= WORD * _lookup({e.key: len(e.words) for e in EVENTS.values()}, "event")]
    for x in SLOTS[3:]:
        if addresses := _has(x, "addr"):
            rules.append(~event.isin(addresses) | F.col(x).startswith("0" * 24))
        if small := _has(x, "u32"):
            rules.append(~event.isin(small) | _small(F.col(x)).isNotNull())
    dynamic, texts = ([k for x in SLOTS for k in _has(x, *kinds)] for kinds in (DYNAMIC, ("bytes",)))
    end = F.col("at") * 2 + WORD + F.col("n") * F.when(event.isin(texts), 2).otherwise(WORD)
    rules.append(~event.isin(dynamic) | F.coalesce(end <= size, false))
    numbers = event.isin([e.key for e in EVENTS.values() if all(f.kind in ("u256", "token", "u32") for f in e.words)])
    full = reduce(lambda a, b: a & b, rules)
    has_data = event.isin([e.key for e in EVENTS.values() if not e.words]) | (F.col("body").rlike(_HEX) & (full | ((F.col("body") == "") & numbers)))
    return rows.withColumns({"has_topics": has_topics, "has_data": has_data})


def decode_all(raw: DataFrame, ids_in_hex: bool = False) -> DataFrame:
    """All events in one pass: event, contract, common fields, and the event's columns as JSON; other logs are ignored. Token
    ids are decimal, or (ids_in_hex) the 64 digits that storage makes bytes of."""
    rows, event = _known(raw).where("has_topics and has_data"), F.col("event")
    numbers = _NUMBERS if ids_in_hex else (*_NUMBERS, "token")
    # the numbers of a log are converted together: what the slots hold, then the items of an array
    start, arrays = F.col("at") * 2 + 1 + WORD, event.isin([k for x in SLOTS for k in _has(x, "u256[]")])
    items = F.transform(F.sequence(F.lit(1).cast("long"), "n"), lambda i: F.substr(F.col("body"), (start + (i - 1) * WORD).cast("int"), F.lit(WORD)))
    items = F.when(arrays & (F.col("n") > 0), items).otherwise(F.array().cast("array<string>"))
    held = F.array(*(F.when(event.isin(_has(x, *numbers)), F.col(x)) for x in SLOTS))
    rows = rows.withColumn("numbers", U.u256_decs(F.concat(held, items)))

    def text(i: int, x: str) -> Column:
        w, out = F.col(x), F.get("numbers", F.lit(i))
        if ids := _has(x, "b32"):
            out = F.when(event.isin(ids), F.concat(F.lit("0x"), w)).otherwise(out)
        if addresses := _has(x, "addr"):
            out = F.when(event.isin(addresses), F.concat(F.lit("0x"), F.right(w, F.lit(40)))).otherwise(out)
        if ids_in_hex and (tokens := _has(x, "token")):
            out = F.when(event.isin(tokens), w).otherwise(out)
        if signed := _has(x, "i256"):
            out = F.when(event.isin(signed), U.i256_dec(F.when(event.isin(signed), w))).otherwise(out)
        if texts := _has(x, "bytes"):
            out = F.when(event.isin(texts), F.concat(F.lit("0x"), F.substr(F.col("body"), start.cast("int"), (F.col("n") * 2).cast("int")))).otherwise(out)
        if lists := _has(x, "u256[]"):
            json = F.when(F.col("n") == 0, "[]").otherwise(F.to_json(F.slice("numbers", F.lit(len(SLOTS) + 1), F.col("n").cast("int"))))
            out = F.when(event.isin(lists), json).otherwise(out)
        return out

    keys = "event", "contract", "block_number", "transaction_index", "transaction_hash", "log_index"
    rows = rows.select(F.inline(F.array(F.struct(*keys, F.array(*(text(i, x) for i, x in enumerate(SLOTS))).alias("texts")))))
    layouts = {e.key: F.array(*(F.struct(F.lit(f.name).alias("name"), F.lit(SLOTS.index(f.place)).alias("slot")) for f in e.fields)) for e in EVENTS.values()}
    layout = F.element_at(F.create_map(*(x for k, v in layouts.items() for x in (F.lit(k), v))), F.col("event"))
    rows = rows.select(F.inline(F.array(F.struct("*", layout.alias("layout")))))
    fields = F.to_json(F.map_from_arrays("layout.name", F.transform("layout.slot", lambda i: F.get("texts", i))))
    return rows.select(*keys, fields.alias("fields"))


def undecodable(raw: DataFrame) -> DataFrame:
    """Logs of known events whose payload is malformed: event, common fields, and the reason."""
    reason = F.when(~F.col("has_topics"), "missing topic").when(~F.col("body").rlike(_HEX), "bad hex").otherwise("short or bad data")
    return _known(raw).where("not (has_topics and has_data)").select("event", "block_number", "transaction_index", "transaction_hash", "log_index", reason.alias("reason"))


def _encoded(f: Field) -> Column:
    c = F.col(f.name)
    if f.kind in ("b32", "addr", "token"):
        return F.lpad(U.strip0x(c), WORD, "0")
    if f.kind == "i256":
        return U.i256_hex(c)
    return F.lpad(F.lower(F.hex(c)), WORD, "0") if f.kind == "u32" else U.u256_hex(c)


def _tail(f: Field) -> Column:
    """Length and items of a dynamic field, padded to whole words."""
    if f.kind == "bytes":
        h = U.strip0x(F.col(f.name))
        return F.concat(F.lpad(F.lower(F.hex(F.call_function("div", F.length(h), F.lit(2)))), WORD, "0"), F.rpad(h, F.ceil(F.length(h) / WORD).cast("int") * WORD, "0"))
    items = F.from_json(F.col(f.name), "array<string>")
    return F.concat(F.lpad(F.lower(F.hex(F.size(items).cast("long"))), WORD, "0"), F.array_join(U.u256_hexes(items), ""))


def encode(events: DataFrame, key: str) -> DataFrame:
    """Logs of typed rows (hex ids without 0x, token ids in hex): the inverse of decode; every second row's address in upper case."""
    e = EVENTS[key]
    contract = F.col("contract") if "contract" in events.columns else F.lit(e.contracts[0])
    address = F.element_at(F.create_map(*[F.lit(x) for kv in CONTRACTS.items() for x in kv]), contract)
    head, tails, at = [], [], F.lit(32 * len(e.words)).cast("long")
    for f in e.words:
        if f.kind in DYNAMIC:
            head.append(F.lpad(F.lower(F.hex(at)), WORD, "0"))
            tails.append(_tail(f))
            at = at + F.call_function("div", F.length(tails[-1]), F.lit(2))
        else:
            head.append(_encoded(f))
    quantity = lambda c: F.concat(F.lit("0x"), F.lower(F.hex(F.col(c).cast("long"))))
    return events.select(
        F.when(F.col("block_number") % 2 == 0, address).otherwise(F.concat(F.lit("0x"), F.upper(F.substr(address, F.lit(3))))).alias("address"),
        quantity("block_number").alias("blockNumber"), F.concat(F.lit("0x"), "transaction_hash").alias("transactionHash"),
        quantity("transaction_index").alias("transactionIndex"), quantity("log_index").alias("logIndex"),
        F.array(F.lit(e.topic0), *(F.concat(F.lit("0x"), _encoded(f)) for f in e.topics)).alias("topics"),
        F.concat(F.lit("0x"), *head, *tails).alias("data"),
    )
