"""Gene lists of any length, families and the whitelist, against plain containment."""

from __future__ import annotations

import random

import pytest

from strandline.operators import genes


def effect(kind, gene, family):
    return f"{kind}(a|b|c|d|1|{gene}|{family}|x|y)"


@pytest.mark.parametrize("n", [0, 3, 3000])
def test_lists_are_plain_containment(spark, n):
    rng = random.Random(n)
    word = lambda k: "".join(rng.choice("ABC1") for _ in range(k))
    entries = [word(rng.randrange(3, 9)) for _ in range(n)] + ([None, "", "é"] if n else [])
    white = ["AB1A", "CC"]
    calls = []
    for k in range(300):
        calls.append(("1", k, ["PASS"], [(rng.choice(["EXON", "UPSTREAM", "INTRON"]), rng.choice([word(rng.randrange(1, 12)), "xéy", ""]), rng.choice(["fam", "other"])) for _ in range(rng.randrange(3))]))
    df = spark.createDataFrame([(c, p, f, [effect(*e) for e in es], k) for k, (c, p, f, es) in enumerate(calls)], "chrom string, pos long, filter array<string>, eff array<string>, entry int")
    frame = lambda v: spark.createDataFrame([(x,) for x in v], "entry string")
    own = [e for e in entries if e]
    for whitelist in (None, white):
        out = genes.blacklist(df, frame(entries), frame(["fam"]), whitelist=None if whitelist is None else frame(whitelist))
        got = {r.pos: r["filter"] for r in out.collect()}
        for _, pos, _, es in calls:
            live = [e for e in es if e[0] not in ("UPSTREAM", "DOWNSTREAM")]
            bad = any(f == "fam" or any(x in g for x in own) for _, g, f in live)
            good = whitelist is not None and any(x in g for _, g, _ in live for x in whitelist)
            assert got[pos] == (["rgene"] if bad and not good else ["PASS"]), (pos, es)
