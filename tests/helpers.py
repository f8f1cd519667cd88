
from tanimart import config

def fp_from_bits(bits):
    """Packed words for a set of bit positions (MSB-first layout)."""
    words = [0] * config.N_WORDS
    for b in bits:
        words[b // 64] |= 1 << (63 - b % 64)
    return [w - (1 << 64) if w >= (1 << 63) else w for w in words]

def fps_frame(spark, rows):
    """rows: [(mol_id, [bits])] -> (mol_id, fp, n_bits)."""
    data = [(m, fp_from_bits(bits), len(set(bits))) for m, bits in rows]
    return spark.createDataFrame(data, "mol_id string, fp array<bigint>, n_bits int")

def pairs_frame(spark, scores, source="S"):
    """Scores in candidate order A, B, C, ... for one source."""
    names = [chr(ord("A") + i) for i in range(len(scores))]
    return spark.createDataFrame([(source, n, float(s)) for n, s in zip(names, scores)],
                                 "source_id string, target_id string, score double")

def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
