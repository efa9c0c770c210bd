"""Operations of a large-scale training-data pipeline.

Each module holds one operator with a general interface; ``queries`` applies all of
them to the test tables. Nothing outside this subpackage imports it.
"""
