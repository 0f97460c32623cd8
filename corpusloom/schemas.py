"""Explicit schemas of the tables the jobs read and write."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

TEXT = _struct(text=_S)
ARTICLE = _struct(id=_L, title=_S, text=_S, url=_S)
VERSE_META = _struct(title=_S, url=_S, author=_S)
VERSE_PAGE = _struct(title=_S, content=_S, source=_S, url=_S, author=_S)
PAGE_ENTRY = _struct(pageid=_L, ns=_I, is_redirect=T.BooleanType())
PAGE_CONTENT = _struct(
    pageid=_L,
    title=_S,
    revisions=T.ArrayType(_struct(slots=_struct(main=_struct(content=_S)))),
)
TRAIN_LOG = _struct(step=_L, loss=_D, eval_loss=_D)
