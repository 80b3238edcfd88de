"""Words, lines and fingerprints of whole texts, see ``weftline.functions.words``."""

from weftline.functions.words import BLANK, CHUNK_BYTES, LOWER, WORD, Texts, chunks, combined, mixed

__all__ = ["BLANK", "CHUNK_BYTES", "LOWER", "WORD", "Texts", "chunks", "combined", "mixed"]
