"""The table models: silver, gold and the batch run that builds them."""
