from __future__ import annotations
