"""Extensions over unbounded input. Gap clusters of a batch are in ``operators.intervals``; nothing here is needed by them."""
