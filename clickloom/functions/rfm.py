"""Score and segment expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.behavior import choose
from clickloom.schema import HIGH_SCORE, KEY_SEGMENT_PREFIX, RECENCY_EDGES, SEGMENTS, VOLUME_EDGES


def _graded(edges, reached, otherwise: int) -> Column:
    column = F
    for edge, score in edges:
        column = column.when(reached(edge), F.lit(score))
    return column.otherwise(F.lit(otherwise))


def recency_score(hours: Column) -> Column:
    return _graded(RECENCY_EDGES, lambda edge: hours <= edge, 1)


def volume_score(count: Column) -> Column:
    return _graded(VOLUME_EDGES, lambda edge: count >= edge, 2)


def segment(r_score: Column, f_score: Column, m_score: Column) -> Column:
    column = F
    for (m_high, r_high, f_high), name in SEGMENTS:
        wanted = [(m_score, m_high), (r_score, r_high), (f_score, f_high)]
        match = F.lit(True)
        for score, high in wanted:
            match = match & ((score >= HIGH_SCORE) if high else (score < HIGH_SCORE))
        column = column.when(match, F.lit(name))
    return column


def segment_order(name: Column) -> Column:
    return choose(name, {label: place for place, (_, label) in enumerate(SEGMENTS)})


def is_key_segment(name: Column) -> Column:
    return name.startswith(KEY_SEGMENT_PREFIX)
