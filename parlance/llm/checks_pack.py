"""Registered query of packing."""
import public_tokenizers

from .checks_text import table
from .packing import pack

SIZE = 2048


def best_fit_packing(spark, sf):
    """All documents packed into sequences of at most 2048 ids."""
    return pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"), size=SIZE)


CHECKS = {"op7_best_fit_packing": (best_fit_packing, None)}
