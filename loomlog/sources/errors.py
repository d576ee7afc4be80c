"""Structured errors of the container."""

from __future__ import annotations

#: Bytes of UTF-8 that messages and textual details keep, the mark included.
MESSAGE_BYTES, DETAIL_BYTES, MARK = 256, 128, "[truncated]"


def bounded(text: str, limit: int) -> tuple[str, bool]:
    """Text of at most ``limit`` UTF-8 bytes, and whether it was cut."""
    raw = text.encode("utf-8")
    if len(raw) <= limit:
        return text, False
    return raw[: limit - len(MARK)].decode("utf-8", "ignore") + MARK, True


class LogError(Exception):
    """A failure of a recording: a stable ``kind``, typed ``details`` and bounded text."""

    def __init__(self, kind: str, message: str = "", **details):
        cut = False
        for name, value in details.items():
            if isinstance(value, str):
                details[name], shortened = bounded(value, DETAIL_BYTES)
                cut |= shortened
        if cut:
            details["truncated"] = True
        self.kind, self.details = kind, details
        text, _ = bounded(message or kind, MESSAGE_BYTES)
        super().__init__(f"{kind}: {text}" if message else kind)

    def __reduce__(self):
        return _rebuild, (self.kind, str(self), self.details)


def _rebuild(kind: str, text: str, details: dict) -> LogError:
    error = LogError(kind, **details)
    error.args = (text,)
    return error
