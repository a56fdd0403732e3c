"""Dataset definitions and the jobs that carry a batch through the layers."""
