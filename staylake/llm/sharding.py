"""Balanced label propagation: linked documents gather in shards of equal row counts.

Documents that share a key are linked. Each round every linked document looks
at how many of its neighbours each shard holds and asks to move to the best
one; requests are granted under a capacity quota per shard. At the end
unlinked documents even out the counts exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylake.llm.common import cut

#: Rounds at most; propagation ends when a round brings no more neighbours together.
ROUNDS = 24
#: Where all documents are linked, a shard takes them in a round up to this multiple of its even share.
QUOTA = 1.05
#: Requests to a shard are granted in this many lots; a key's documents are in one lot.
LOTS = 64
#: A key of at least this part of a share is large: it starts in one shard, and what makes way there are other documents.
LARGE = 1 / 16
#: Documents of a key that one task joins to the key's counts, about.
JOINED = 1_000
#: Rows ranked by one task at a time, about.
RANK_UNIT = 2_000


def grant(flows: list[tuple[int, int, int, int]], load: list[float], limit: float) -> set[int]:
    """Lots granted, as ``target * LOTS + lot``.

    ``flows`` has (from, to, lot, rows). Lots are taken in turn; within a lot
    the shards that would end above ``limit`` take nobody, and with the
    documents that then stay, others may have to refuse as well. The numbers
    are sums over shards and lots, never documents.
    """
    granted = set()
    for lot in range(LOTS):
        here = [(a, b, n) for a, b, q, n in flows if q == lot]
        open_ = {b for _, b, _ in here}
        while open_:
            new = list(load)
            for a, b, n in here:
                if b in open_:
                    new[a] -= n
                    new[b] += n
            over = {b for b in open_ if new[b] > limit and new[b] > load[b]}
            if not over:
                load[:] = new
                granted |= {b * LOTS + lot for b in open_}
                break
            open_ -= over
    return granted


def large_starts(keys: list[tuple[int, int]], share: float, shards: int) -> list[tuple[int, int, int]]:
    """``(key, part, shard)`` of the large keys (key, rows): the largest first, each part where least is yet."""
    load, out = [0.0] * shards, []
    for key, n in sorted(keys, key=lambda k: (-k[1], k[0])):
        parts = -(-n // share)
        for part in range(int(parts)):
            s = min(range(shards), key=lambda s: (load[s], s))
            load[s] += n / parts
            out.append((key, part, s))
    return out


def propagate(docs: DataFrame, unit: str, keys: str, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """``u, shard, key, large``: the shard of every linked unit of ``docs``, and whether its key is large.

    ``unit`` is a long column that names a row (rows of one unit move
    together), ``keys`` an array<long> column. A key with more rows than a
    shard's even share is cut into parts of at most a share, which count as
    keys of their own; any other can end in one shard. Large keys (of which
    there are at most 16 a shard and key of a row) start together, all other
    documents anywhere. Each round is three
    joins and aggregations on keys and units, checkpointed; the documents of
    a large key are joined to its counts by many tasks. Only sums by shards
    and lots reach the driver.
    """
    total = docs.count()
    share = max(total / shards, 1.0)
    members = docs.select(F.col(unit).alias("u"), F.explode(F.array_distinct(keys)).alias("key")).where("key is not null")
    members = members.groupBy("u", "key").agg(F.count("*").alias("w"))
    sizes = members.groupBy("key").agg(F.sum("w").alias("n")).where("n > 1")
    sizes = cut(sizes)
    many = sizes.where(F.col("n") >= share * LARGE).orderBy(F.desc("n"), "key").limit(64 * shards).collect()
    starts = docs.sparkSession.createDataFrame(large_starts([(r["key"], r.n) for r in many], share, shards), "key long, part int, start int")
    parts = F.ceil(F.col("n") / F.lit(share)).cast("int")
    part = F.when(parts > 1, F.pmod(F.xxhash64(F.col("u"), F.lit("part")), parts).cast("int")).otherwise(F.lit(0))
    cuts = F.ceil(F.least("n", F.lit(share)) / F.lit(float(JOINED))).cast("int")
    members = members.join(sizes, "key").withColumn("part", part).join(F.broadcast(starts), ["key", "part"], "left").select(
        "u",
        "w",
        F.when(parts > 1, F.xxhash64("key", "part")).otherwise(F.col("key")).alias("key"),
        "start",
        F.greatest(cuts, F.lit(1)).alias("cuts"),
    )
    members = cut(members.withColumn("salt", F.pmod(F.xxhash64("u", F.lit("salt")), F.col("cuts")).cast("int")))
    first = F.coalesce(F.min("start"), F.pmod(F.xxhash64("u"), F.lit(shards)).cast("int"))
    large = F.max(F.col("start").isNotNull()).alias("large")
    labels = cut(members.groupBy("u").agg(F.max("w").alias("w"), F.min("key").alias("key"), large, first.alias("shard")))
    members = members.select("u", "key", "cuts", "salt")
    numbers = F.sequence(F.lit(0), F.lit(shards - 1))
    # Unlinked documents make way later, so linked ones may fill a shard; beyond its share only where few are unlinked.
    linked = labels.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
    limit, full, together = share + (share * (QUOTA - 1) + 1) * linked / max(total, 1), [], -1
    for r in range(rounds):
        held = members.join(labels.select("u", "w", "shard"), "u").groupBy("key").agg(
            F.array(*[F.sum(F.when(F.col("shard") == s, F.col("w")).otherwise(0)) for s in range(shards)]).alias("held"),
            F.max("cuts").alias("cuts"),
        )
        held = held.select("key", "held", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("salt"))
        votes = members.join(held, ["key", "salt"]).groupBy("u").agg(
            F.array(*[F.sum(F.col("held")[s]) for s in range(shards)]).alias("votes")
        )
        # Ties go by a hash that the documents of a key share, so that they agree on one shard.
        # A full shard is asked for only by documents most of whose neighbours it holds.
        n = lambda s: F.element_at("votes", s + 1)
        most = F.aggregate("votes", F.lit(0).cast("long"), lambda a, x: a + x)
        asks = lambda s: ~s.isin(full) | (2 * n(s) > most) if full else F.lit(True)
        best = lambda s: F.struct(asks(s).alias("open"), n(s).alias("n"), F.xxhash64("key", s).alias("tie"), s.alias("s"))
        want = F.array_max(F.transform(numbers, best))["s"]
        lot = F.pmod(F.xxhash64(F.col("key"), F.lit(r)), F.lit(LOTS)).cast("int")
        asked = labels.join(votes, "u").withColumn("want", want).withColumn("lot", lot)
        asked = cut(asked.select("u", "w", "key", "large", "shard", "want", "lot", (F.col("w") * n(F.col("shard"))).alias("near")))
        sums = asked.groupBy("shard").agg(F.sum("w").alias("n"), F.sum("near").alias("near")).collect()
        # Pairs of linked documents that share a shard: the fewer edges are cut, the more.
        if sum(x.near for x in sums) <= together:
            return before.select("u", "shard", "key", "large")
        together, before = sum(x.near for x in sums), asked
        flows = asked.where("want <> shard").groupBy("shard", "want", "lot").agg(F.sum("w").alias("n")).collect()
        loads = {x.shard: x.n for x in sums}
        load = [loads.get(s, 0) for s in range(shards)]
        granted = grant(sorted((x["shard"], x.want, x["lot"], x.n) for x in flows), load, limit)
        full = [s for s in range(shards) if load[s] > 0.99 * limit]
        if not granted:
            return asked.select("u", "shard", "key", "large")
        yes = (F.col("want") * LOTS + F.col("lot")).isin(sorted(granted))
        labels = asked.select("u", "w", "key", "large", F.when(yes, F.col("want")).otherwise(F.col("shard")).alias("shard"))
    return labels.select("u", "shard", "key", "large")


def even_out(rows: DataFrame, shards: int, order: list[str]) -> DataFrame:
    """``rows`` with final ``shard`` and ``slot``: counts at most one apart, slots gapless from 0.

    ``rows`` has a proposed ``shard``, ``key`` (null for unlinked rows) and
    ``large``. Within a shard rows of large keys come first, then other
    linked rows, by key, then the others; rows
    ranked beyond the shard's share fill the shards that lack rows. Ranks come
    from counts of small units and a rank within each, so no task ranks a
    whole shard.
    """
    h = F.xxhash64(F.coalesce(F.col("key"), F.xxhash64(*order)), F.lit("rank"))
    rows = rows.withColumn("_h", h)
    counts = {r["shard"]: r.n for r in rows.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    counts = [counts.get(s, 0) for s in range(shards)]
    total = sum(counts)
    units = max(max(counts, default=0) // RANK_UNIT, 1)
    # A unit is a range of key hashes, and within it a share of the rows of large keys.
    lead = F.floor(F.pmod(F.col("_h"), F.lit(1 << 30)) / F.lit((1 << 30) / units)).cast("int")
    rows = rows.withColumn("_unit", F.when(F.col("key").isNull(), lead + 2 * units).when(F.col("large"), lead).otherwise(lead + units))
    rows = rows.withColumn("_sub", F.pmod(F.xxhash64(*order, F.lit("sub")), F.lit(16)).cast("int"))
    from pyspark.sql import Window

    size = rows.groupBy("shard", "_unit", "_sub").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("shard").orderBy("_unit", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    size = size.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    rows = rows.join(size, ["shard", "_unit", "_sub"])
    within = Window.partitionBy("shard", "_unit", "_sub").orderBy("_h", *order)
    rows = rows.withColumn("_rank", F.col("_ahead") + F.row_number().over(within) - 1)
    # The larger shares go to the shards that hold most.
    share, more = divmod(total, shards)
    rich = sorted(range(shards), key=lambda s: (-counts[s], s))[:more]
    due = [share + (s in rich) for s in range(shards)]
    over, lack, gone, come = [], [], 0, 0
    for s in range(shards):
        over.append(gone)
        lack.append(come)
        gone += max(counts[s] - due[s], 0)
        come += max(due[s] - counts[s], 0)
    array = lambda v: F.array(*[F.lit(x).cast("long") for x in v])
    at = lambda v, s: F.element_at(array(v), s + 1)
    surplus = F.col("_rank") - at(due, F.col("shard"))
    rows = rows.withColumn("_e", F.when(surplus >= 0, at(over, F.col("shard")) + surplus))
    # The last shard whose gap starts at or before the row: shards without a gap have the next one's start.
    gaps = [s for s in range(shards) if due[s] > counts[s]]
    to = F.lit(0)
    for s in gaps:
        to = F.when(F.col("_e") >= lack[s], F.lit(s)).otherwise(to)
    rows = rows.withColumn("_to", to.cast("int"))
    slot = F.when(F.col("_e").isNull(), F.col("_rank")).otherwise(
        at(counts, F.col("_to")) + F.col("_e") - at(lack, F.col("_to"))
    )
    return rows.withColumns(
        {"slot": slot.cast("long"), "shard": F.when(F.col("_e").isNull(), F.col("shard")).otherwise(F.col("_to")).cast("int")}
    ).drop("_h", "_unit", "_sub", "_ahead", "_rank", "_e", "_to")


def shard_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 16, rounds: int = ROUNDS
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: one row for each row of ``docs``.

    Documents of equal texts are linked (by SHA-256). Row counts of shards are
    at most one apart; slots of a shard are gapless from 0. A null text has
    size 1, CRC 0 and no links; empty texts are equal to each other. A null id
    is a value like any other; repeated rows each get a slot. A key may hold
    any part of the rows: beyond a shard's share it is cut into parts. An
    empty table gives an empty result. Columns other than the id and the text
    are not read.
    """
    t = F.col(text)
    digest = F.sha2(t, 256)
    key = F.xxhash64(digest)
    base = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(t), F.lit(0)).cast("long").alias("text_crc32"),
        F.when(t.isNotNull(), F.array(key)).otherwise(F.array().cast("array<long>")).alias("keys"),
    )
    base = cut(base.withColumn("u", F.xxhash64("doc_id", "keys")))
    found = propagate(base, "u", "keys", shards, rounds)
    rows = base.drop("keys").join(found, "u", "left")
    home = F.pmod(F.xxhash64("u"), F.lit(shards)).cast("int")
    rows = cut(rows.withColumn("shard", F.coalesce("shard", home)))
    return even_out(rows, shards, ["doc_id", "text_crc32", "size"]).drop("u", "key", "large")
