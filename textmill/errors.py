"""Errors that say something about an input, not about the job."""


class InvalidPoint(ValueError):
    """Parameters that cannot give a model, such as an empty vocabulary; a search counts them as failed."""
