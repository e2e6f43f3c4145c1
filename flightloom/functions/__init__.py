from flightloom.functions.drift import payload_drift
from flightloom.functions.envelope import decode, decode_nested, encode, messages, record_key

__all__ = ["decode", "decode_nested", "encode", "messages", "payload_drift", "record_key"]
