"""Operations of a training-data pipeline over the tables ``documents``, ``labels``, ``embeddings`` and ``conversations``.

Every operator takes a DataFrame, reads only the columns it names (others may be there, under any name) and returns rows
that carry the id. The thin registered queries are in ``queries.py``.
"""
