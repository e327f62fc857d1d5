"""A deterministic stand-in for the external feature service.

The answer for an id is a pure function of ``md5(id)``, so a re-run (or a
retried task) returns the same records.  Ids whose md5 starts with ``0``
are "not found" (``None``), exercising the empty-answer path.
"""

from __future__ import annotations

import hashlib


def _unit(h: str) -> float:
    return int(h, 16) / 4294967296.0


def hashed_track_service(ids: list) -> list:
    out = []
    for i in ids:
        h = hashlib.md5(str(i).encode()).hexdigest()
        if h[0] == "0":
            out.append(None)
            continue
        out.append({
            "id": str(i),
            "uri": f"x:track:{i}",
            "type": "audio_features",
            "danceability": _unit(h[1:9]),
            "energy": _unit(h[9:17]),
            "key": int(h[17:19], 16) % 12,
            "mode": int(h[19], 16) % 2,
            "tempo": 60.0 + int(h[20:24], 16) % 140,
        })
    return out


from setlist._workers import ship_by_value  # noqa: E402

ship_by_value(__name__)
