"""Physical-layout building blocks shared by the operators."""
