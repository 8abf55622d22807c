SELECT codcli AS cod_cliente, prest AS prestacao, duplic AS duplicata, CAST(valor AS DOUBLE) AS valor,
       dtvenc AS dt_vencimento, CAST(vpago AS DOUBLE) AS valor_pago, CAST(txperm AS DOUBLE) AS txperm,
       dtpag AS dt_pagamento, dtemissao AS dt_emissao, codfilial AS cod_filial, codusur AS cod_vendedor,
       CAST(valordesc AS DOUBLE) AS vl_desconto, CAST(vldevol AS DOUBLE) AS vl_devolucao, dtdevol AS dt_devolucao,
       codsupervisor AS cod_supervisor, numtransvenda, numped, codemitentepedido AS cod_emitente_pedido
FROM pcprest
WHERE dtemissao >= DATE '2000-01-01' AND dtcancel IS NULL AND dtpag IS NULL
