"""Schemas of the inputs, as Spark DDL."""

from __future__ import annotations

_TX = "hash string, nonce string, blockHash string, blockNumber string, transactionIndex string, `from` string, `to` string, value string, gas string, gasPrice string, input string, v string, r string, s string, yParity string, type string, typeHex string, chainId string, maxFeePerGas string, maxPriorityFeePerGas string, accessList string"
_LOG = "address string, topics array<string>, data string, blockNumber string, transactionHash string, transactionIndex string, blockHash string, logIndex string, removed boolean"
_RECEIPT = f"blockHash string, blockNumber string, contractAddress string, cumulativeGasUsed string, effectiveGasPrice string, `from` string, gasUsed string, logs array<struct<{_LOG}>>, logsBloom string, status string, `to` string, transactionHash string, transactionIndex string, type string"
_BLOCK = (
    "number string, hash string, parentHash string, timestamp string, miner string, difficulty string, totalDifficulty string, size string, gasLimit string, gasUsed string, baseFeePerGas string, blockGasCost string, "
    f"transactions array<struct<{_TX}>>, stateRoot string, transactionsRoot string, receiptsRoot string, extraData string, blockExtraData string, extDataHash string, extDataGasUsed string, logsBloom string, mixHash string, nonce string, sha3Uncles string, uncles array<string>, "
    "blobGasUsed string, excessBlobGas string, parentBeaconBlockRoot string, minDelayExcess string, timestampMilliseconds string"
)
#: A trace's result is the raw JSON of its call tree, since trees nest without a bound.
NORMALIZED_BLOCK = f"block struct<{_BLOCK}>, traces array<struct<txHash string, result string>>, receipts array<struct<{_RECEIPT}>>"
CALL = "`from` string, gas string, gasUsed string, `to` string, input string, output string, error string, revertReason string, calls array<string>, value string, type string"
OUT = "struct<kind:string,asset_id:string,amount:decimal(20,0),addresses:array<string>,threshold:bigint,locktime:decimal(20,0),group_id:bigint,payload:string,utxo_id:string,utxo_bytes:string>"
IN = "struct<utxo_id:string,amount:decimal(20,0)>"
CATALOGUE = "map<string, struct<name: string, evmChainId: bigint, subnetId: string, indexer: string, info: string>>"
VERTEX_PAGE = "vertices array<struct<hash string, timestamp string, transactions array<string>>>"

#: Columns and types of the six exported tables, with the names that the warehouse uses.
_BASE = "blockhash string, blocknumber bigint, blocktimestamp bigint"
EVM_TABLES = {
    "blocks": "blocktimestamp bigint, blockhash string, blocknumber bigint, blockbasefeepergas decimal(38,0), blockgaslimit bigint, blockgasused bigint, blockparenthash string, blockreceipthash string, blockreceiptsroot string, blocksize bigint, blockstateroot string, blocktransactionlen bigint, blockextradata string, blockextdatagasused decimal(38,0), blockgascost decimal(38,0), partition_date date",
    "transactions": f"{_BASE}, transactionhash string, transactionfrom string, transactionto string, transactiongas bigint, transactiongasprice bigint, transactionmaxfeepergas decimal(38,0), transactionmaxpriorityfeepergas decimal(38,0), transactioninput string, transactionnonce bigint, transactionindex bigint, transactioncost decimal(38,0), transactionvalue decimal(38,0), transactiontype string, partition_date date",
    "receipts": f"{_BASE}, transactionhash string, transactionreceiptgasused bigint, transactionreceiptcumulativegasused bigint, transactionreceiptstatus bigint, transactionreceiptcontractaddress string, transactionreceiptpoststate string, transactionreceipteffectivegasprice bigint, partition_date date",
    "logs": f"{_BASE}, transactionhash string, logaddress string, topichex_0 string, topichex_1 string, topichex_2 string, topichex_3 string, topicdec_0 string, topicdec_1 string, topicdec_2 string, topicdec_3 string, logdata string, logindex bigint, transactionindex bigint, removed boolean, partition_date date",
    "internal_transactions": f"{_BASE}, transactionhash string, type string, from_address string, to_address string, value decimal(38,0), gas bigint, gasused bigint, revert boolean, error string, revertreason string, input string, output string, callindex string, trace_position bigint, partition_date date",
    "messages": f"{_BASE}, transactionhash string, transactionmessagefrom string, transactionmessageto string, transactionmessagegasprice bigint, partition_date date",
}
#: Names of columns that the CSV form writes differently.
CSV_NAMES = {"from_address": "from", "to_address": "to"}


def ddl(table: str, location: str, prefix: str = "") -> str:
    """CREATE TABLE for one of the six tables, partitioned by date."""
    return f"CREATE TABLE IF NOT EXISTS {prefix}{table} ({EVM_TABLES[table]}) USING parquet PARTITIONED BY (partition_date) LOCATION '{location}'"
