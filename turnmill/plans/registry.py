"""All registered queries with their oracle SQL."""

from __future__ import annotations

from turnmill.plans import agents, chats, corpus, evaluation, retrieval, sessions

_AREAS = (evaluation, corpus, chats, retrieval, agents, sessions)

QUERIES = {name: query for area in _AREAS for name, query in area.QUERIES.items()}
ORACLE = {name: sql for area in _AREAS for name, sql in area.ORACLE.items()}
