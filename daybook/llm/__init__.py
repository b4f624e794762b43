"""Operations of a training-data pipeline, one module per operator.

Nothing outside this package imports it; ``queries`` registers its queries.
"""
