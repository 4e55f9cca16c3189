"""Conversation structure repair: the cheapest edits that make a conversation's roles a sentence of the role grammar.

All rows of all conversations are numbered in one distributed sort and cut into blocks of equal size, wherever
conversations begin and end. Within a block a generalised LR parser (role_stacks) reads each conversation's rows over the
graph-structured stack, from the empty stack and, where a conversation comes in from the block before, from every stack.
What it finds for a segment is a small table (stack before, stack after, cost, audit); segments of a conversation are then
joined by costs and the order of their audits alone. So a conversation of any length is read by many tasks at once.
"""
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import prepare
from panelkit.llm.role_stacks import ROLES, RoleStacks, merged
from panelkit.operators.spread import number_rows, split_join
from panelkit.session import materialise

#: Rows that one parser reads at a time, and the characters that are no words.
BLOCK, BLANKS = 1 << 12, " \t\n\x0b\x0c\r"
#: The roles that rows can be given, by initial.
GIVEN = {"u": "user", "a": "assistant"}
_STACKS: dict[tuple, RoleStacks] = {}


def stacks(rules=ROLES) -> RoleStacks:
    """One numbering of a grammar's stacks for each process; it depends on the rules only."""
    if rules not in _STACKS:
        _STACKS[rules] = RoleStacks(rules, "".join(GIVEN))
    return _STACKS[rules]


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after faults by crc32 of `conv_id:turn` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    its full stops, question and exclamation marks, 3 repeats it, 4 makes it a user's. Nulls in texts are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(spaced("text"), ".?!", "")).otherwise(spaced("text"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.when(fault == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"), F.explode(F.when(fault == 0, F.array().cast("array<int>")).when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy")).drop("__copy")


def _said(*names: str) -> Column:
    """One value for equal rows: a SHA-256 over the parts with their lengths."""
    parts = [x for n in names for x in (F.length(F.col(n).cast("string")).cast("string"), F.col(n).cast("string"))]
    return F.unhex(F.sha2(F.concat_ws(":", *[F.coalesce(p, F.lit("")) for p in parts]).cast("binary"), 256))


def faults(rows: DataFrame) -> DataFrame:
    """The rows' facts without texts, from numbered rows: position, conv_id, turn, initial, blank, duplicate, truncated. A row's
    first fault counts; a duplicate has the role and text (by SHA-256) of an earlier row of its conversation."""
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    facts = rows.select(
        "position", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), (body == "").alias("blank"),
        (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("__open"), _said("conv_id", "role", "text").alias("__said"))
    first = facts.groupBy("__said").agg(F.min("position").alias("__first"))
    seen = F.col("position") > F.col("__first")
    return split_join(facts, first, ["__said"]).select(
        "position", "conv_id", "turn", "initial", "blank", (~F.col("blank") & seen).alias("duplicate"),
        (~F.col("blank") & ~seen & F.col("__open")).alias("truncated"))


_WAY = pa.struct([("before", pa.int32()), ("after", pa.int32()), ("cost", pa.int64()), ("place", pa.int32()), ("audit", pa.string())])
_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("initials", pa.string()), ("illegal", pa.int64()), ("ways", pa.list_(_WAY))])
SEGMENTS = "conv_id long, position long, initials string, illegal long, ways array<struct<before: int, after: int, cost: long, place: int, audit: string>>"


def _legal(two: str) -> bool:
    return two in ("su", "ua", "au")


def segments(facts: DataFrame, block: int = BLOCK, rules=ROLES) -> DataFrame:
    """SEGMENTS: one row for each conversation in each block of positions, with the least (cost, audit) between any two stacks;
    `place` orders the segment's audits."""
    def parsed(t: pa.Table) -> pa.Table:
        t = t.sort_by("position")
        names = "conv_id", "position", "initial", "blank", "duplicate", "truncated"
        rows = list(zip(*(t[n].to_pylist() for n in names), strict=True))
        g, out, a = stacks(rules), [], 0
        while a < len(rows):
            b = a
            while b < len(rows) and rows[b][0] == rows[a][0]:
                b += 1
            kinds = [(i, blank or duplicate, truncated) for _, _, i, blank, duplicate, truncated in rows[a:b]]
            # only the block's first conversation can have begun before it
            ways = [(start, to, *way) for start in (range(len(g.nodes)) if a == 0 else [0]) for to, way in g.through(kinds, start).items()]
            place = {audit: k for k, audit in enumerate(sorted({w[3] for w in ways}))}
            initials = [i or "" for i, _, _ in kinds]
            out.append((rows[a][0], rows[a][1], "".join(i or "?" for i in initials), sum(not _legal(x + y) for x, y in zip(initials, initials[1:])),
                        [{"before": before, "after": to, "cost": cost, "place": place[audit], "audit": audit} for before, to, cost, audit in ways]))
            a = b
        return _table(out, _SEGMENTS)

    numbered = facts.withColumn("__block", F.floor((F.col("position") - 1) / block))
    return numbered.groupBy("__block").applyInArrow(parsed, SEGMENTS)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_CHOSEN = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("before", pa.int32()), ("after", pa.int32()), ("closing", pa.string()),
                     ("cost", pa.int64()), ("illegal", pa.int64())])
CHOSEN = "conv_id long, position long, before int, after int, closing string, cost long, illegal long"


def joined(segs: DataFrame, rules=ROLES) -> DataFrame:
    """CHOSEN: for each segment the stacks before and after it on its conversation's least way, and the rows inserted at the
    end. Cost and illegal neighbours of the whole conversation stand at its last segment, and are null before.

    A conversation's segments pass one task in order, without audits: a few numbers for each BLOCK rows.
    """
    def walk(batches):
        g = stacks(rules)
        closing = g.closing()
        conv, path, links, tops, illegal, last = object(), [], [], {}, 0, ""

        def close():
            ends = [(cost + closing[s][0], place, closing[s][1], s) for s, (cost, place) in tops.items() if s in closing]
            cost, _, letters, at = min(ends)
            rows = []
            for position, link in zip(reversed(path), reversed(links), strict=True):
                before = link[at][0]
                rows.append((conv, position, before, at, "" if rows else letters, None if rows else cost, None if rows else illegal))
                at = before
            return rows

        for b in batches:
            out = []
            for c, position, first, end, inside, ways in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if path and c != conv:
                    out += close()
                if not path or c != conv:
                    path, links, tops, illegal, last = [], [], {0: (0, 0)}, 0, None
                conv = c
                best: dict[int, tuple] = {}
                for w in ways:
                    if w["before"] in tops:
                        cost, place = tops[w["before"]]
                        way = cost + w["cost"], place, w["place"], w["before"]
                        if w["after"] not in best or way < best[w["after"]]:
                            best[w["after"]] = way
                tops, link = merged(best)
                path.append(position)
                links.append(link)
                illegal += inside + (last is not None and not _legal(last + first))
                last = end
            if out:
                yield from _table(out, _CHOSEN).to_batches()
        if path:
            yield from _table(close(), _CHOSEN).to_batches()

    first, last = F.substring("initials", 1, 1), F.right("initials", F.lit(1))
    light = F.transform("ways", lambda w: w.dropFields("audit"))
    ordered = segs.select("conv_id", "position", first.alias("first"), last.alias("last"), "illegal", light.alias("ways")).repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return ordered.mapInArrow(walk, CHOSEN)


_EDITS = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("place", pa.int32()), ("action", pa.string()), ("given", pa.string())])
EDITS = "conv_id long, position long, place int, action string, given string"


def edits(segs: DataFrame, chosen: DataFrame, rules=ROLES) -> DataFrame:
    """EDITS: one row for each edit, in order of position and place; inserted rows have the position of the row they precede,
    or at the end of the last row."""
    way = F.filter("ways", lambda w: (w.before == F.col("before")) & (w.after == F.col("after")))[0]
    picked = segs.drop("illegal").join(chosen.drop("conv_id"), "position").select("conv_id", "position", "before", F.concat(way.audit, F.col("closing")).alias("audit"), "initials")

    def replayed(batches):
        g = stacks(rules)
        for b in batches:
            out = []
            for conv, position, before, audit, initials in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                at, place, end = position, 0, position + len(initials) - 1
                for letter, role in g.replay(before, audit, initials):
                    out.append((conv, min(at, end), place, letter, GIVEN.get(role)))
                    place += 1
                    if letter != "I":
                        at, place = at + 1, 0 if at < end else place
            if out:
                yield from _table(out, _EDITS).to_batches()

    return picked.mapInArrow(replayed, EDITS)


def repair(rows: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Repair rows conv_id, turn, role, text: the conversations' facts, and all edits with their rows.

    Facts: conv_id, n_rows, gaps, blank, duplicate, truncated, illegal, cost. Edits: conv_id, position (of the row in all rows),
    place, action (K kept, D deleted, R given a role, I inserted), turn, role (after the edit), text (null for deleted rows).

    Rows go by turn (nulls first), then role, text and place in their input; equal rows are all kept as rows, the later ones
    as duplicates. Null roles and texts are one space, which is blank and no role; rows without conv_id are one conversation; other columns
    are not read. An empty table gives no rows. A text's length doesn't matter: the parser reads facts only.
    """
    prepare(rows.sparkSession)
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    given = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *spaced, F.monotonically_increasing_id().alias("__id"))
    ordered = number_rows(given, ["conv_id", "turn", "role", "text", "__id"]).drop("__id")
    facts = materialise(faults(ordered))
    segs = materialise(segments(facts, block))
    chosen = materialise(joined(segs))
    counts = facts.groupBy("conv_id").agg(
        F.count("*").alias("n_rows"), F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"),
        *[F.count_if(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    whole = chosen.where("cost is not null").select(F.col("conv_id").alias("__c"), "illegal", "cost")
    conversations = counts.join(whole, F.col("conv_id").eqNullSafe(F.col("__c"))).drop("__c")
    made = edits(segs, chosen).withColumn("__own", F.when(F.col("action") != "I", F.col("position")))
    own = ordered.select(F.col("position").alias("__own"), "turn", "role", "text")
    gone, new = F.col("action") == "D", F.col("action") == "I"
    return conversations, made.join(own, "__own", "left").select(
        "conv_id", "position", "place", "action", "turn", F.coalesce("given", "role").alias("role"), F.when(new, "").when(~gone, F.col("text")).alias("text"))


def audits(edited: DataFrame) -> DataFrame:
    """conv_id, audit (the actions in order) and repaired_sha256 (of `role:text` of what is left, newline-joined) of every
    conversation, from repair's edits. A digest has one order, so a conversation passes one task, row by row."""
    kind = pa.schema([("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def digests(batches):
        conv, letters, digest, lines = None, [], None, 0

        def row():
            return conv, "".join(letters), digest.hexdigest()

        for b in batches:
            out = []
            for c, action, role, text in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if digest is None or c != conv:
                    if digest is not None:
                        out.append(row())
                    conv, letters, digest, lines = c, [], hashlib.sha256(), 0
                letters.append(action)
                if action != "D":
                    digest.update((b"\n" if lines else b"") + f"{role}:{text}".encode())
                    lines += 1
            if out:
                yield from _table(out, kind).to_batches()
        if digest is not None:
            yield from _table([row()], kind).to_batches()

    ordered = edited.repartition("conv_id").sortWithinPartitions("conv_id", "position", "place")
    return ordered.select("conv_id", "action", "role", "text").mapInArrow(digests, "conv_id long, audit string, repaired_sha256 string")
