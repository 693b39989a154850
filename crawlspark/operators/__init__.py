"""DataFrame to DataFrame building blocks. All are lazy unless their docstring says otherwise."""
