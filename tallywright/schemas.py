"""Schemas of the stored records. Readers always get one, so no file is read to infer it."""

from pyspark.sql import types as T

_S, _L, _D, _B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_TEXTS = T.ArrayType(_S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PROBLEM = _struct(
    task_id=_L, text=_S, code=_S, test_list=_TEXTS, test_setup_code=_S,
    challenge_test_list=_TEXTS,
)
PROBLEM_TABLE = T.StructType(PROBLEM.fields + [T.StructField("split", _S)])

MODEL_RESPONSE = _struct(
    error=_S,
    choices=T.ArrayType(
        _struct(index=_L, message=_struct(role=_S, content=_S), finish_reason=_S)
    ),
    usage=_struct(prompt_tokens=_L, completion_tokens=_L, total_tokens=_L),
)


def response(id_field: str = "problem_id") -> T.StructType:
    return _struct(
        **{id_field: _L}, problem=PROBLEM, prompt=_S, model_response=MODEL_RESPONSE,
        timestamp=_D,
    )


def evaluation(id_field: str = "problem_id") -> T.StructType:
    return _struct(
        **{id_field: _L}, problem_statement=_S, passed=_B, error=_S, test_outputs=_TEXTS,
        generated_code=_S, test_cases=_TEXTS,
    )


def attempt_fields(id_field: str = "problem_id") -> T.StructType:
    """The two evaluation fields that pass rates need."""
    return _struct(**{id_field: _L}, passed=_B)


def pivot(runs: list[str], id_field: str = "problem_id") -> T.StructType:
    return _struct(**{id_field: _L}, **{f"run_{run}_pass": _B for run in runs})


def pass_at_k(ks: list[int], id_field: str = "problem_id") -> T.StructType:
    return _struct(**{id_field: _L}, **{f"pass@{k}": _D for k in ks})


def sample(ks: list[int], id_field: str = "problem_id") -> T.StructType:
    return T.StructType(pass_at_k(ks, id_field).fields + [T.StructField("difficulty", _S)])


TRAIN_ROW = _struct(instruction=_S, output=_S)
