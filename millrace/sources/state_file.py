"""What is known of each source, in a small SQLite file beside the record log, so that a run can go on where it stopped.

The record log is the truth: opening the file brings it up to what the log completes.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterable
from pathlib import Path

#: The file's tables, which the audit reads.
TABLES = """
CREATE TABLE IF NOT EXISTS documents (source_id TEXT PRIMARY KEY, seen INTEGER NOT NULL DEFAULT 0, completed INTEGER NOT NULL DEFAULT 0);
CREATE TABLE IF NOT EXISTS pending (source_id TEXT PRIMARY KEY);
"""
_PUT = "INSERT INTO documents VALUES (?, 1, ?) ON CONFLICT DO UPDATE SET seen = 1, completed = max(completed, excluded.completed)"


class StateFile:
    def __init__(self, path: Path, completed: Iterable[str] = ()):
        path.parent.mkdir(parents=True, exist_ok=True)
        self.db = sqlite3.connect(path)
        self.db.executescript(TABLES)
        self.note(completed=completed)

    def note(self, seen: Iterable[str] = (), completed: Iterable[str] = (), pending: Iterable[str] = ()) -> None:
        """One transaction; what is completed is seen and no longer pending."""
        done = [(i,) for i in completed]
        with self.db:
            self.db.executemany(_PUT, [(i, 0) for i in seen])
            self.db.executemany(_PUT, [(*i, 1) for i in done])
            self.db.executemany("DELETE FROM pending WHERE source_id = ?", done)
            self.db.executemany("INSERT OR REPLACE INTO pending VALUES (?)", [(i,) for i in pending])

    def status(self, source_id: str) -> tuple[bool, bool]:
        """(seen, completed)"""
        row = self.db.execute("SELECT seen, completed FROM documents WHERE source_id = ?", (source_id,)).fetchone()
        return (bool(row[0]), bool(row[1])) if row else (False, False)

    def rows(self) -> list[tuple[str, bool]]:
        """(source, completed) of all sources."""
        return [(i, bool(done)) for i, done in self.db.execute("SELECT source_id, completed FROM documents")]

    def pending(self) -> list[str]:
        return [i for (i,) in self.db.execute("SELECT source_id FROM pending ORDER BY source_id")]

    def counts(self) -> dict[str, int]:
        seen, done = self.db.execute("SELECT coalesce(sum(seen), 0), coalesce(sum(completed), 0) FROM documents").fetchone()
        return {"seen_count": seen, "completed_count": done, "pending_count": len(self.pending())}

    def close(self) -> None:
        self.db.close()
