"""Small helpers shared by the operators, see ``weftline.operators.tables``."""

from weftline.operators.tables import BROADCAST_BYTES, LABEL_BYTES, components, in_batches, kept, sized

__all__ = ["BROADCAST_BYTES", "LABEL_BYTES", "components", "in_batches", "kept", "sized"]
