"""The small scale and a text of 300 different words."""

SF = "/root/testdata/sf0.01"
PASSAGE = " ".join(f"word{i}x" for i in range(300))
