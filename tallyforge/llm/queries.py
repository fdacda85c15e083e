"""The registered queries of this subpackage, and SQL where it can express them."""

from __future__ import annotations

from tallyforge.llm import codes, decontaminate, langid, lm, mixing, negatives, quality, secrets, sharding, simhash, toxicity, urls, warc


def queries():
    return {
        "op1_simhash": simhash.op1,
        "op2_decontaminate": decontaminate.op2,
        "op3_mixing": mixing.op3,
        "op4_toxicity": toxicity.op4,
        "op5_secrets": secrets.op5,
        "op6_langid": langid.op6,
        "op7_quality": quality.op7,
        "op8_warc_roundtrip": warc.op8,
        "op9_lm_mixing": lm.op9,
        "op10_shard_interleave": sharding.op10,
        "op11_hard_negatives": negatives.op11,
        "op12_vector_codes": codes.op12,
        "op13_url_filter": urls.op13,
    }


def oracle_sql():
    return {"op8_warc_roundtrip": warc.ORACLE_SQL, "op11_hard_negatives": negatives.ORACLE_SQL, "op12_vector_codes": codes.ORACLE_SQL, "op13_url_filter": urls.ORACLE_SQL}
