"""Layer plans composed from operators."""
