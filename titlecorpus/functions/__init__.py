"""Column expressions (JVM-side, codegen-friendly) shared by operators."""

from titlecorpus.functions.text import (
    WS_CLASS,
    is_blank,
    normalize_ws,
    strip_ws,
    task_prefix,
    tokenize,
)
from titlecorpus.functions.keys import seeded_hash, seeded_int

__all__ = [
    "WS_CLASS", "is_blank", "normalize_ws", "strip_ws", "task_prefix", "tokenize",
    "seeded_hash", "seeded_int",
]
