"""Compound files: the streams of an OLE container, by path. Only what reading documents needs."""

from __future__ import annotations

import struct

END, FREE = 0xFFFFFFFE, 0xFFFFFFFF


class BrokenContainer(ValueError):
    """Bytes that are no readable compound file."""


class CompoundFile:
    """Streams of a compound file; sector chains are followed with a guard, so a damaged table ends in an error."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != bytes.fromhex("D0CF11E0A1B11AE1") or len(data) < 512:
            raise BrokenContainer("no compound file")
        self.data = data
        self.sector = 1 << struct.unpack_from("<H", data, 30)[0]
        self.mini = 1 << struct.unpack_from("<H", data, 32)[0]
        n_fat, first_dir = struct.unpack_from("<II", data, 44)
        self.cutoff, first_mini, _, first_difat, n_difat = struct.unpack_from("<IIIII", data, 56)
        if self.sector not in (512, 4096) or self.mini > self.sector:
            raise BrokenContainer("sector sizes make no sense")
        tables = list(struct.unpack_from("<109I", data, 76))
        at = first_difat
        for _ in range(n_difat):
            more = struct.unpack(f"<{self.sector // 4}I", self._sector(at))
            tables += more[:-1]
            at = more[-1]
        self.fat: list[int] = []
        for t in [t for t in tables if t < END][:n_fat]:
            self.fat += struct.unpack(f"<{self.sector // 4}I", self._sector(t))
        self.mini_fat = self._words(self._chain(first_mini)) if first_mini < END else []
        self.entries = self._directory(self._chain(first_dir))
        root = self.entries[""]
        self.mini_data = self._chain(root[0])[: root[1]] if root[0] < END else b""

    def _sector(self, i: int) -> bytes:
        start = (i + 1) * self.sector
        if start >= len(self.data):
            raise BrokenContainer(f"sector {i} lies beyond the end")
        return self.data[start : start + self.sector].ljust(self.sector, b"\0")

    @staticmethod
    def _words(data: bytes) -> list[int]:
        return list(struct.unpack(f"<{len(data) // 4}I", data))

    def _chain(self, start: int) -> bytes:
        parts, seen = [], 0
        while start < END:
            seen += 1
            if seen > len(self.fat) or start >= len(self.fat):
                raise BrokenContainer("a chain of sectors does not end")
            parts.append(self._sector(start))
            start = self.fat[start]
        return b"".join(parts)

    def _directory(self, data: bytes) -> dict[str, tuple[int, int]]:
        rows = []
        for i in range(0, len(data) - 127, 128):
            size = struct.unpack_from("<H", data, i + 64)[0]
            name = data[i : i + max(0, size - 2)].decode("utf-16-le", "replace")
            kind = data[i + 66]
            left, right, child = struct.unpack_from("<III", data, i + 68)
            start, length = struct.unpack_from("<II", data, i + 116)
            rows.append((name, kind, left, right, child, start, length))
        out: dict[str, tuple[int, int]] = {"": (rows[0][5], rows[0][6])} if rows else {}
        todo, seen = [(rows[0][4], "")] if rows else [], set()
        while todo:
            i, folder = todo.pop()
            if i >= len(rows) or i in seen:
                continue
            seen.add(i)
            name, kind, left, right, child, start, length = rows[i]
            todo += [(left, folder), (right, folder)]
            if kind == 1:
                todo.append((child, f"{folder}{name}/"))
            elif kind == 2:
                out[folder + name] = (start, length)
        return out

    def names(self) -> list[str]:
        return sorted(n for n in self.entries if n)

    def read(self, name: str) -> bytes:
        start, size = self.entries[name]
        if size >= self.cutoff:
            return self._chain(start)[:size]
        parts, seen = [], 0
        while start < END and len(parts) * self.mini < size:
            seen += 1
            if start >= len(self.mini_fat) or seen > len(self.mini_fat):
                raise BrokenContainer("a chain of small sectors does not end")
            parts.append(self.mini_data[start * self.mini : (start + 1) * self.mini])
            start = self.mini_fat[start]
        return b"".join(parts)[:size]
