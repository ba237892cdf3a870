"""Column expressions and the feature map that names them."""
