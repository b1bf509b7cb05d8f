"""Set operators over tables; every one takes column roles and returns a DataFrame."""
