"""Conversation repair beside an enumeration of all edits, beside its SQL, and its edge cases."""
import hashlib
import itertools
import random
import re

import duckdb
import pytest

from panelkit.llm import conversation_repair as cr
from panelkit.llm.queries import ORACLE_SQL, op11_lr_repair
from panelkit.llm.role_stacks import Automaton, RoleStacks

NAMES = {"u": "user", "a": "assistant", "s": "system"}


def cheapest(rows):
    """The least (cost, audit, roles) by trying every edit of every row with up to two rows inserted before it and at the end."""
    best = None
    inserts = ["", "u", "a", "ua", "au", "uu", "aa"]
    choices = [[("D", 4, "")] if must_go else [("D", 4, ""), ("K", 3 * faulty, i), *(("R", 3 + 3 * faulty, t) for t in "ua")] for i, must_go, faulty in rows]
    for before in itertools.product(inserts, repeat=len(rows) + 1):
        for own in itertools.product(*choices):
            said = "".join(x + c[2] for x, c in zip(before, own)) + before[-1]
            if re.fullmatch("(s?(ua)+)?", said) and not any(c[0] == "K" and not c[2] for c in own):
                cost = 3 * sum(map(len, before)) + sum(c[1] for c in own)
                audit = "".join("I" * len(x) + c[0] for x, c in zip(before, own)) + "I" * len(before[-1])
                best = min(best or (99, "", ""), (cost, audit, said))
    return best


def test_every_edit():
    g, rng = RoleStacks(), random.Random(8)
    for n in (0, 1, 2, 3):
        for _ in range(100 if n < 3 else 12):
            rows = [(rng.choice("suuaax"), rng.random() < 0.2, rng.random() < 0.3) for _ in range(n)]
            ends = g.closing()
            cost, audit = min((way[0] + ends[s][0], way[1] + ends[s][1]) for s, way in g.through(rows, 0).items() if s in ends)
            want = cheapest([(i if i != "x" else "?", m, f) for i, m, f in rows])
            assert (cost, audit) == want[:2], rows
            made = [role or i for (x, role), i in zip(g.replay(0, audit, "".join(i for i, _, _ in rows)), _initials(audit, rows)) if x != "D"]
            assert "".join(made) == want[2]


def _initials(audit, rows):
    left = iter(rows)
    return [None if x == "I" else next(left)[0] for x in audit]


def test_grammars():
    with pytest.raises(ValueError, match="bound"):
        RoleStacks((("C", ""), ("C", "uaC")))
    with pytest.raises(ValueError, match="two reductions"):
        Automaton((("C", "A"), ("C", "B"), ("A", "u"), ("B", "u")))
    pairs = RoleStacks((("C", "ua"), ("C", "Cua")))          # at least one pair, no system row
    assert pairs.accepting[0] is False and min(pairs.closing().values()) == (0, "") and pairs.closing()[0] == (6, "II")


def damaged(s, rows):
    return s.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("cost", cr.F.lit("x")).withColumn("position", cr.F.lit(1))


ODD = [(1, None, "user", "Who?"), (1, None, "user", "Who?"), (1, 2, None, None), (1, 2, "assistant", "It is me."), (None, 0, "user", "No id?"), (None, 1, "tool", "No id."),
       (2, 0, "system", "Alone."), (3, 0, "user", " \n"), (4, 0, "assistant", "x" * 300_000), (5, 1, "user", "Ä?"), (5, 1, "user", "Ä?"), (5, 9, "assistant", "no end"), (6, 0, "", "Empty role.")]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng, out = random.Random(4), tmp_path_factory.mktemp("conv")
    rows = [(c, t, rng.choice(["user", "assistant", "system", "user", "assistant", "other"]), rng.choice(["Yes.", "No?", "so", "", "Really!", f"{c} {t}."]))
            for c in range(40) for t in range(rng.randrange(9))]
    rows += [(99, t // 2, "user" if rng.random() < 0.5 else "assistant", f"{rng.randrange(300)}.") for t in range(600)]     # one long conversation
    damaged(spark, rows + ODD).write.parquet(f"{out}/conversations.parquet")
    return str(out)


def test_beside_sql(spark, tables):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from read_parquet('{tables}/conversations.parquet/*.parquet')")
    want = con.execute(ORACLE_SQL["op11_lr_repair"]).fetchall()
    got = op11_lr_repair(spark, tables)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    facts, edited = cr.repair(cr.damage(spark.read.parquet(f"{tables}/conversations.parquet")), block=7)   # conversations across many blocks
    again = {r.conv_id: (r.audit, r.repaired_sha256) for r in cr.audits(edited).collect()}
    assert all(again.get(w[0], ("", hashlib.sha256().hexdigest())) == w[7:] for w in want)
    assert {r.conv_id: r.cost for r in facts.collect()} == {w[0]: w[6] for w in want if w[0] in again}


def test_odd_conversations(spark):
    facts, edited = cr.repair(damaged(spark, ODD), block=2)
    by = {r.conv_id: r for r in facts.collect()}
    said = {r.conv_id: r.audit for r in cr.audits(edited).collect()}
    assert by[1].duplicate == 1 and by[1].blank == 1 and by[1].gaps == 0 and said[1] == "KDDK"
    assert said[None] == "KR" and by[None].cost == 3
    assert said[2] == "D" and said[3] == "D" and said[4] == "D" and by[4].truncated == 1     # a faulty row and its pair cost 6, without it 4
    assert by[5].gaps == 7 and said[5] == "KDK" and by[5].cost == 4 + 3
    assert said[6] == "D" and by[6].illegal == 0
    rows = sorted(edited.where("conv_id = 1").collect(), key=lambda r: (r.position, r.place))
    assert [(r.action, r.role, r.text) for r in rows if r.action != "D"] == [("K", "user", "Who?"), ("K", "assistant", "It is me.")]
    none, nothing = cr.repair(damaged(spark, ODD).where("false"))
    assert none.count() == 0 and nothing.count() == 0 and cr.audits(nothing).count() == 0
