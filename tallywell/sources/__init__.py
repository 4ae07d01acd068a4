from .codec import accepted, checked_messages, decode_messages, encode_messages, rejected
from .messages import read_messages, stream_messages, write_messages
from .synth import synth_clients, synth_products, synth_transactions

__all__ = [
    "accepted",
    "checked_messages",
    "decode_messages",
    "encode_messages",
    "read_messages",
    "rejected",
    "stream_messages",
    "synth_clients",
    "synth_products",
    "synth_transactions",
    "write_messages",
]
