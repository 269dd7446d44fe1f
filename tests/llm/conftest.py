import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

#: tests of the parent folder import it from the module "conftest", which is this one when both folders are collected
SF_SMALL = "/root/testdata/sf0.001"
