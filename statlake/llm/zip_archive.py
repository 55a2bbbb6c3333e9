"""ZIP packages by byte range: a streaming writer of stored members and a
reader that never extracts.

The reader needs only ``size`` and ``read(start, length)``: it finds the end
record from the tail, follows the ZIP64 locator where fields are full, parses
the central directory and gives each stored member's byte range.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

#: Fixed values of the format.
LOCAL, CENTRAL, END, END64, LOCATOR, DESCRIPTOR = (b"PK\3\4", b"PK\1\2", b"PK\5\6", b"PK\6\6", b"PK\6\7", b"PK\7\x08")
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
STAMP = (0, 0x21)  # 1980-01-01 00:00


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    crc: int
    packed: int
    size: int
    header: int  # offset of the local header


class ZipWriter:
    """Writes stored members to a stream that can't seek.  Sizes follow each
    member in a descriptor and stand in the central directory; ZIP64 fields
    are used where a size, offset or count needs them, or always if ``zip64``."""

    def __init__(self, stream, zip64: bool = False):
        self.stream, self.at, self.zip64 = stream, 0, zip64
        self.members: list[Member] = []
        self.open: list | None = None

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.open = [name, self.at, 0, 0]
        # the ZIP64 extra makes the descriptor's sizes 8 bytes wide
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(LOCAL + struct.pack("<HHHHHIIIHH", 45, 0x0808, 0, *STAMP, 0, FULL32, FULL32, len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> int:
        """Append to the open member; the offset in it where ``data`` starts."""
        at = self.open[3]
        self.open[2] = zlib.crc32(data, self.open[2])
        self.open[3] += len(data)
        self._put(data)
        return at

    def end(self) -> None:
        name, header, crc, size = self.open
        self._put(DESCRIPTOR + struct.pack("<IQQ", crc, size, size))
        self.members.append(Member(name, 0, crc, size, size, header))
        self.open = None

    def close(self) -> None:
        start = self.at
        for m in self.members:
            raw = m.name.encode()
            wide_size, wide_at = self.zip64 or m.size >= FULL32, self.zip64 or m.header >= FULL32
            extra = (struct.pack("<QQ", m.size, m.packed) if wide_size else b"") + (struct.pack("<Q", m.header) if wide_at else b"")
            extra = struct.pack("<HH", 1, len(extra)) + extra if extra else b""
            size = FULL32 if wide_size else m.size
            self._put(CENTRAL + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0x0808, 0, *STAMP, m.crc, size, size, len(raw), len(extra),
                                            0, 0, 0, 0, FULL32 if wide_at else m.header) + raw + extra)
        size, n = self.at - start, len(self.members)
        if self.zip64 or n >= FULL16 or size >= FULL32 or start >= FULL32:
            at = self.at
            self._put(END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, size, start))
            self._put(LOCATOR + struct.pack("<IQI", 0, at, 1))
            self._put(END + struct.pack("<HHHHIIH", 0, 0, FULL16, FULL16, FULL32, FULL32, 0))
        else:
            self._put(END + struct.pack("<HHHHIIH", 0, 0, n, n, size, start, 0))


class ZipReader:
    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read = read
        tail_at = max(0, size - 22 - FULL16)
        tail = read(tail_at, size - tail_at)
        at = tail.rfind(END)
        while at >= 0 and (len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
            at = tail.rfind(END, 0, at)
        if at < 0:
            raise ValueError("no ZIP end record")
        end = tail_at + at
        n, length, start = struct.unpack_from("<10xHII", tail, at)
        before = end  # where the directory must end
        if end >= 20 and (n == FULL16 or length == FULL32 or start == FULL32):
            locator = read(end - 20, 20)
            if locator[:4] == LOCATOR:
                at64 = struct.unpack_from("<8xQ", locator)[0]
                record = read(at64, 56)
                if record[:4] != END64:  # bytes were put before the package
                    at64 = end - 20 - 56
                    record = read(at64, 56)
                if record[:4] != END64:
                    raise ValueError("damaged ZIP64 end record")
                n, length, start = struct.unpack_from("<32xQQQ", record)
                before = at64
        self.shift = before - (start + length)
        if self.shift < 0:
            raise ValueError("damaged ZIP directory")
        self.members = self._directory(read(start + self.shift, length), n)

    def _directory(self, data: bytes, n: int) -> list[Member]:
        out, at = [], 0
        for _ in range(n):
            if data[at:at + 4] != CENTRAL:
                raise ValueError("damaged ZIP directory")
            flags, method, crc, packed, size, n_name, n_extra, n_note, header = struct.unpack_from("<4xHH4xIIIHHH8xI", data, at + 4)
            name = data[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
            x, end = at + 46 + n_name, at + 46 + n_name + n_extra
            while x + 4 <= end:
                kind, length = struct.unpack_from("<HH", data, x)
                if kind == 1:
                    wide = list(struct.unpack_from(f"<{length // 8}Q", data, x + 4))
                    size = wide.pop(0) if size == FULL32 and wide else size
                    packed = wide.pop(0) if packed == FULL32 and wide else packed
                    header = wide.pop(0) if header == FULL32 and wide else header
                x += 4 + length
            out.append(Member(name, method, crc, packed, size, header))
            at = end + n_note
        return out

    def stored(self, member: Member) -> int:
        """Where a stored member's bytes start in the package."""
        if member.method:
            raise ValueError(f"{member.name}: only stored members can be read by range")
        head = self.read(member.header + self.shift, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"{member.name}: no local header")
        n_name, n_extra = struct.unpack_from("<26xHH", head)
        return member.header + self.shift + 30 + n_name + n_extra
