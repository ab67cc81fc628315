"""The two conditions that stop a job instead of being counted."""


class DuplicateKeyError(Exception):
    """A strict merge refused its batch: ``clashes`` keys would be stored twice, of which
    ``sample`` is the first."""

    def __init__(self, clashes: int, sample: str) -> None:
        super().__init__(f"{clashes} keys of the batch clash, the first is {sample}")
        self.clashes = clashes
        self.sample = sample


class StrictValidationError(Exception):
    """Strict validation met rows of a class that must halt the run."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.counts = counts
        super().__init__(f"rows that halt a strict run: {counts}")
