"""The registered corpus queries, by name, and SQL for those that SQL can express."""

from windrisk.llm import (circulant, digest_merge, divergence, langid, line_templates, mixing, phrase_automata, piece_bpe,
                          prefix_trie, repetition, revisits, template, toxic)
from windrisk.llm.common import Query

QUERIES: dict[str, Query] = {
    "op1_suffix_repetition": repetition.op1_suffix_repetition,
    "op2_class_templates": template.op2_class_templates,
    "op3_tree_merge_dedup": digest_merge.op3_tree_merge_dedup,
    "op4_circulant_minhash": circulant.op4_circulant_minhash,
    "op5_revisits": revisits.op5_revisits,
    "op6_line_templates": line_templates.op6_line_templates,
    "op7_epoch_mix": mixing.op7_epoch_mix,
    "op8_automata_toxicity": toxic.op8_automata_toxicity,
    "op9_agenda_pieces": piece_bpe.op9_agenda_pieces,
    "op10_kneser_ney": langid.op10_kneser_ney,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_phrase_automata": phrase_automata.op12_phrase_automata,
    "op13_hash_recount": divergence.op13_hash_recount,
}

ORACLES: dict[str, str] = {
    "op3_tree_merge_dedup": digest_merge.OP3_SQL,
    "op5_revisits": revisits.OP5_SQL,
    "op7_epoch_mix": mixing.OP7_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_phrase_automata": phrase_automata.OP12_SQL,
    "op13_hash_recount": divergence.OP13_SQL,
}
