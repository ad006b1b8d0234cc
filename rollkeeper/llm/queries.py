"""Registered queries of the corpus operators, and SQL where SQL can express them."""

from rollkeeper.llm import classlm, decontaminate, huffman, jaccard, lexical, licences, negatives, packing, perplexity, runlength, shards, simhash, warc

QUERIES = {
    "op1_decontamination": decontaminate.op1_decontamination,
    "op2_quality": perplexity.op2_quality,
    "op3_licences": licences.op3_licences,
    "op4_simhash": simhash.op4_simhash,
    "op5_sharding": shards.op5_sharding,
    "op6_huffman": huffman.op6_huffman,
    "op7_repeats": runlength.op7_repeats,
    "op8_classes": classlm.op8_classes,
    "op9_packing": packing.op9_packing,
    "op10_warc": warc.op10_warc,
    "op11_negatives": negatives.op11_negatives,
    "op12_jaccard": jaccard.op12_jaccard,
    "op13_lexical": lexical.op13_lexical,
}

SQL = {**jaccard.SQL, **lexical.SQL, **licences.SQL, **negatives.SQL}
