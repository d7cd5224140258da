"""Failures of arguments and inputs, each with a stable code."""


class ChronofoldError(Exception):
    code = "XX000"


class NullArgument(ChronofoldError, ValueError):
    code = "22004"


class InvalidArgument(ChronofoldError, ValueError):
    code = "22023"


class NotFound(ChronofoldError, LookupError):
    code = "P0002"


class Ambiguous(ChronofoldError, LookupError):
    code = "21000"


class ContractError(ChronofoldError, ValueError):
    code = "22000"


class ProviderError(ChronofoldError, RuntimeError):
    code = "58000"


class Conflict(ChronofoldError, RuntimeError):
    code = "23505"
