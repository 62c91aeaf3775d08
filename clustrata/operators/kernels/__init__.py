"""NumPy kernels for what needs a whole small matrix; they run inside single tasks."""
