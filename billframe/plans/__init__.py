"""Composed plans: the batch run over captured inputs and the rendered-order plans."""
