"""Fisher score of calls from reference and variant depths in normal and tumour samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.fisher import p_value, phred_score, point


def score(calls: DataFrame) -> DataFrame:
    """Adds p, qual and ssc. Needs final_type, passes and the depths dn_ref, dn_alt, rn_ref, ... rt_alt (long, 0 where absent).

    Only somatic calls need a tail; where the expected table has no variant reads its right tail is one point. Types without a test, and calls that
    do not pass, get p .98 and 0.
    """
    ref, alt = {s: F.col(f"{s}_ref") for s in ("dn", "rn", "dt", "rt")}, {s: F.col(f"{s}_alt") for s in ("dn", "rn", "dt", "rt")}
    all_ref, all_alt = sum(ref.values()), sum(alt.values())
    zero = F.lit(0).cast("long")
    rna_ref, rna_alt = ref["rn"] + ref["rt"], alt["rn"] + alt["rt"]
    kind, ok = F.col("final_type"), F.col("passes")
    p = (
        F.when(ok & (kind == "GERM"), point(all_ref + all_alt, zero, all_ref, all_alt))
        .when(ok & (kind == "SOM"), p_value(ref["dn"] + ref["rn"], alt["dn"] + alt["rn"], ref["dt"] + ref["rt"], alt["dt"] + alt["rt"]))
        .when(ok & (kind == "TUM_EDIT"), point(all_ref + all_alt, zero, rna_ref, rna_alt))
        .otherwise(0.98)
    )
    out = calls.withColumn("p", p)
    qual = F.when(ok & kind.isin("GERM", "SOM", "TUM_EDIT"), phred_score(F.col("p"))).otherwise(F.lit(0).cast("long"))
    return out.withColumns({"qual": qual, "ssc": F.when(kind == "SOM", qual).otherwise(F.lit(0).cast("long"))})
