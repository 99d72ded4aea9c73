"""lotledger.functions"""
